"""The driver's tables, seen as the engine's input tables.

One SQL text per view serves Spark and the checking engine; only the three
tokens below differ (integer day arithmetic and JSON access)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnpanel.sources.tables import spread

TOKENS = {
    "spark": {
        "@DAY": "(datediff(cast(ts as date), date'2024-01-01') + 1)",
        "@K": "cast(get_json_object(props,'$.k') as int)",
        "@SHIP": "datediff(cast(l_shipdate as date), date'1995-01-01')",
    },
    "duckdb": {
        "@DAY": "(date_diff('day', date '2024-01-01', cast(ts as date)) + 1)",
        "@K": "cast(json_extract_string(props,'$.k') as int)",
        "@SHIP": "date_diff('day', date '1995-01-01', cast(l_shipdate as date))",
    },
}

# the large tables' unique keys
UNIQUE = {"lineitem": ["l_orderkey", "l_linenumber"]}

MONEY = "LARGE"
ITEMS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

VIEWS: dict[str, str] = {
    "fx_event": """
        select event_id, user_id as acc_id, user_id*4 + (@K % 4) as char_id,
          ((@DAY - 1) % 28 + 28) % 28 + 1 as day, event_type, value, @K as k
        from events""",
    "fx_combat": """
        select day, acc_id, char_id, concat('s', cast(acc_id % 5 as string)) as server,
          k % 8 as class, cast(floor(value) as bigint) as level,
          case when event_type='error' then 1 else 0 end as pledge_cnt,
          case when event_type='click' then 1 else 0 end as random_attacker_cnt,
          case when k % 4 = 0 then 1 else 0 end as random_defender_cnt,
          case when event_type='signup' then 1 else 0 end as temp_cnt,
          case when event_type='purchase' then 1 else 0 end as same_pledge_cnt,
          k % 3 as etc_cnt, k % 10 as num_opponent, event_id as row_seq
        from fx_event where event_type <> 'view'""",
    "fx_activity": """
        select day, acc_id, char_id, concat('s', cast(acc_id % 5 as string)) as server,
          case when k % 3 = 0 then 0.0 else value end as playtime, k as npc_kill,
          case when event_type='click' then value else 0.0 end as solo_exp,
          case when event_type='view' then value else 0.0 end as party_exp,
          case when event_type='purchase' then value else 0.0 end as quest_exp,
          case when event_type='signup' and k % 3 <> 0 then value else 0.0 end as fishing,
          case when event_type='error' then value else 0.0 end as private_shop,
          value - 50.0 as game_money_change,
          case when k % 5 = 0 then 1 else 0 end as rich_monster,
          case when k % 7 = 0 then 1 else 0 end as death,
          case when k % 14 = 0 then 1 else 0 end as revive,
          case when k % 21 = 0 then 1 else 0 end as exp_recovery,
          case when k % 11 = 0 then 1 else 0 end as enchant_count
        from fx_event""",
    "fx_pledge_day": """
        select cast(c_nationkey as bigint) as pledge_id, day,
          count(distinct acc_id) as play_char_cnt,
          count(distinct case when event_type in ('error','purchase') then acc_id end) as combat_char_cnt,
          sum(case when event_type='error' then 1 else 0 end) as pledge_combat_cnt,
          sum(case when event_type='click' then 1 else 0 end) as random_attacker_cnt,
          sum(case when event_type='view' then 1 else 0 end) as random_defender_cnt,
          sum(case when event_type='purchase' then 1 else 0 end) as same_pledge_cnt,
          sum(case when event_type='signup' then 1 else 0 end) as temp_cnt,
          sum(k % 3) as etc_cnt,
          sum(case when event_type='error' then cast(value as decimal(18,2)) else 0 end) as combat_play_time,
          sum(case when event_type<>'error' then cast(value as decimal(18,2)) else 0 end) as non_combat_play_time
        from fx_event join customer on acc_id = c_custkey group by c_nationkey, day""",
    "fx_pledge": """
        select p.*, m.acc_id, m.char_id, concat('s', cast(m.acc_id % 5 as string)) as server
        from (select distinct e.acc_id, e.char_id, e.day, c.c_nationkey
              from fx_event e join customer c on e.acc_id = c.c_custkey
              where e.event_type in ('error','purchase')) m
          join fx_pledge_day p on p.pledge_id = m.c_nationkey and p.day = m.day""",
    "fx_trade0": """
        select l_orderkey, l_linenumber, l_partkey, (@SHIP % 28) + 1 as day,
          case when l_orderkey % 97 = 0 then 0 when l_orderkey % 101 = 0 then 21600
               else (l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 86400 end as sec,
          case when l_returnflag='A' then 1 else 0 end as type,
          concat('s', cast(l_suppkey % 5 as string)) as server,
          l_suppkey as source_acc_id, l_suppkey*4 + (l_linenumber % 4) as source_char_id,
          o_custkey as target_acc_id, o_custkey*4 + (l_linenumber % 4) as target_char_id,
          p_type as item_type, l_quantity as item_amount,
          case when l_returnflag='A' or p_type='LARGE' then null else l_extendedprice end as item_price
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "fx_trade": """
        select day,
          concat(lpad(cast(cast(floor(sec/3600) as bigint) as string),2,'0'), ':',
                 lpad(cast(cast(floor((sec%3600)/60) as bigint) as string),2,'0'), ':',
                 lpad(cast(sec%60 as string),2,'0')) as time,
          type, server, source_acc_id, source_char_id, target_acc_id, target_char_id,
          item_type, item_amount, item_price
        from fx_trade0""",
    "fx_payment": """
        select day, acc_id, sum(cast(value as decimal(18,2))) as amount_spent
        from fx_event where event_type='purchase' group by day, acc_id""",
    "fx_label": """
        select c_custkey as acc_id,
          case when c_custkey % 3 = 0 then 64 else 1 + (c_custkey*37) % 63 end as survival_time,
          case when c_acctbal <= 0 or c_custkey % 4 = 1 then 0.0 else c_acctbal / 10000 end as amount_spent
        from customer""",
    "fx_pred": """
        select c_custkey as acc_id,
          case when c_custkey % 5 = 0 then 64 else 1 + (c_custkey*41) % 63 end as survival_time,
          case when c_custkey % 7 = 2 then 0.0 else abs(c_acctbal) * (1 + c_custkey % 20) / 100000 end as amount_spent
        from customer""",
}

# the tables and views each view reads
INPUTS: dict[str, list[str]] = {
    "fx_event": ["events"],
    "fx_combat": ["fx_event"],
    "fx_activity": ["fx_event"],
    "fx_pledge_day": ["fx_event", "customer"],
    "fx_pledge": ["fx_event", "customer", "fx_pledge_day"],
    "fx_trade0": ["lineitem", "orders", "part"],
    "fx_trade": ["fx_trade0"],
    "fx_payment": ["fx_event"],
    "fx_label": ["customer"],
    "fx_pred": ["customer"],
}


def view_sql(name: str, engine: str) -> str:
    text = VIEWS[name]
    for token, expr in TOKENS[engine].items():
        text = text.replace(token, expr)
    return text


class Inputs:
    """Lazy access to the driver's tables and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in VIEWS:
                # every input frame is passed by name: no global temp views
                text = view_sql(name, "spark")
                used = {n: self.table(n) for n in INPUTS[name]}
                text = _brace(text, used)
                self._frames[name] = self.spark.sql(text, **used)
            else:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
                self._frames[name] = spread(df, *UNIQUE[name]) if name in UNIQUE else df
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(f"fx_{name}" if f"fx_{name}" in VIEWS else name)


def _brace(text: str, names) -> str:
    """Mark the input names after FROM and JOIN as frame parameters."""
    words = []
    previous = ""
    for word in text.split():
        if previous.lower() in ("from", "join") and word in names:
            words.append("{" + word + "}")
        else:
            words.append(word)
        previous = word
    return " ".join(words)
