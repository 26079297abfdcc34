"""DuckDB SQL for every query that SQL can express.

Written from the definitions of the operators and straight over the rows: joins
where the Spark side pre-aggregates, unions where it explodes, brute force where
it prunes.  Named intermediate results are chained as common table expressions."""

from __future__ import annotations

import re

from churnpanel.plans.contract import shape_sql
from churnpanel.plans.specs import (
    CORR_LABELS, IMPUTED, KNN_FEATURES, PANEL, SPECS, TRADE_CORR,
)
from churnpanel.plans.queries import BASE_TABLES, HUB_DEGREE, LOOKUP_ACCOUNT, PREPARED_MIN_CORR, SLICE, WINDOW_WEIGHTS
from churnpanel.schema import (
    ACTIVITY_MEASURES, COMBAT_MEASURES, LEVEL_COLUMNS, MEAN_FILL, PANEL_RENAME,
    PAYMENT_STATS, PLEDGE_MEASURES, PLEDGE_RENAME, SQUEEZE_MEAN, TRADE_DAILY_COLUMNS,
)
from churnpanel.sources.adapters import ITEMS, MONEY, VIEWS, view_sql


def _each(names, text: str, sep: str = ", ") -> str:
    return sep.join(text.replace("$c", n) for n in names)


def _sums(names) -> str:
    return _each(names, "coalesce(sum($c), 0) as $c")


NAMED: dict[str, str] = {name: view_sql(name, "duckdb") for name in VIEWS}

# --- rollups ---------------------------------------------------------------
NAMED["q_activity"] = f"""
  select *, solo_exp + party_exp + quest_exp as total_exp,
    fishing / nullif(playtime, 0) as fishing_prop, quest_exp / nullif(playtime, 0) as qexp_per_playtime,
    solo_exp / nullif(playtime, 0) as sexp_per_playtime, party_exp / nullif(playtime, 0) as pexp_per_playtime,
    1 as activity_logged_in
  from (select acc_id, day, {_sums(ACTIVITY_MEASURES)} from fx_activity group by acc_id, day)"""
NAMED["q_major"] = """
  select class, n, cum_n, case when 10 * cum_n <= 6 * tot then 1 else 0 end as is_major
  from (select class, n, sum(n) over (order by n desc, class rows unbounded preceding) as cum_n,
               sum(n) over () as tot
        from (select class, count(*) as n from fx_combat group by class))"""
NAMED["q_levels"] = """
  select acc_id, sum(f) as tot_start_lv, sum(l) as tot_end_lv, sum(l) - sum(f) as changed_lv,
    avg(f) as avg_start_lv, avg(l) as avg_end_lv
  from (select acc_id, char_id,
          max(case when up = 1 then level end) as f, max(case when down = 1 then level end) as l
        from (select *, row_number() over (partition by acc_id, char_id order by day, row_seq) as up,
                row_number() over (partition by acc_id, char_id order by day desc, row_seq desc) as down
              from fx_combat)
        group by acc_id, char_id)
  group by acc_id"""
NAMED["q_combat"] = f"""
  select c.*, {_each(LEVEL_COLUMNS, "v.$c")}
  from (select acc_id, day, {_sums(COMBAT_MEASURES)}, count(*) as combat_count,
          avg(is_major) as "isMajorClass", 1 as combat_logged_in
        from fx_combat join q_major using (class) group by acc_id, day) c
  left join q_levels v on c.acc_id = v.acc_id"""


def _scores(size: str) -> str:
    return f"""
  select pledge_id, people as pledge_num_people,
    rate / max(rate) over () as avg_play_rate_per_pledge,
    cast(combats as double) / nullif(max(combats) over (), 0) as total_combat_cnt_per_pledge
  from (select pledge_id, avg(play_char_cnt) as rate, sum(pledge_combat_cnt) as combats,
          {size} as people from fx_pledge group by pledge_id)"""


NAMED["q_scores"] = _scores("count(*)")
_pledge_sums = ", ".join(
    f"coalesce(sum({c}), 0) as {PLEDGE_RENAME.get(c, c)}" for c in PLEDGE_MEASURES
)
NAMED["q_pledge"] = f"""
  select acc_id, day, {_pledge_sums}, sum(avg_play_rate_per_pledge) as avg_play_rate_per_pledge,
    sum(total_combat_cnt_per_pledge) as total_combat_cnt_per_pledge,
    avg(pledge_num_people) as pledge_num_people, 1 as pledge_logged_in
  from fx_pledge join q_scores using (pledge_id) group by acc_id, day"""
NAMED["q_payday"] = """
  select acc_id, day, cast(sum(amount_spent) as double) as amount_spent from fx_payment group by acc_id, day"""
_spent = """max(amount_spent) $w as max_spent, min(amount_spent) $w as min_spent,
    avg(amount_spent) $w as mean_spent, sum(amount_spent) $w as tot_spent,
    median(amount_spent) $w as median_spent"""
NAMED["q_payment"] = f"""
  select acc_id, day, amount_spent, {_spent.replace("$w", "over (partition by acc_id)")},
    1 as payment_logged_in from q_payday"""

# --- trades ----------------------------------------------------------------
_hms = "cast(replace(time, ':', '') as int)"


def _bin(edges: list[int]) -> str:
    arms = " ".join(
        f"when {_hms} > {lo} and {_hms} <= {hi} then {i}"
        for i, (lo, hi) in enumerate(zip(edges, edges[1:]))
    )
    return f"(case {arms} end)"


BIN4 = _bin([0, 60000, 120000, 180000, 239999])
BIN24 = _bin([*range(0, 240000, 10000), 239999])

NAMED["q_scaled"] = f"""
  select t.* exclude (item_amount, item_price), {BIN4} as bin4, {BIN24} as bin24,
    case when item_type = '{MONEY}' then 1.0 else item_amount / lo_amount end as item_amount,
    case when item_type = '{MONEY}' then item_amount / lo_amount else item_price / lo_price end as item_price
  from fx_trade t,
    (select min(item_amount) as lo_amount, min(item_price) as lo_price from fx_trade) m"""
NAMED["q_normal"] = f"select * from q_scaled where not (type = 1 and item_type <> '{MONEY}')"
_entry = "day, type, item_type, item_amount, item_price, coalesce(bin4, 0) as time_bin"
NAMED["q_ledger"] = f"""
  select source_acc_id as acc_id, 'sell' as side, {_entry} from q_normal where item_type <> '{MONEY}'
  union all select target_acc_id, 'get', {_entry} from q_normal where item_type <> '{MONEY}'
  union all select target_acc_id, 'sell', {_entry} from q_normal where item_type = '{MONEY}'
  union all select source_acc_id, 'get', {_entry} from q_normal where item_type = '{MONEY}'"""
NAMED["q_counts"] = """
  select coalesce(s.acc_id, g.acc_id) as acc_id, coalesce(s.n, 0) as count_sell,
    coalesce(g.n, 0) as count_get, coalesce(s.n, 0) + coalesce(g.n, 0) as total_trade_count,
    coalesce(s.n + g.n, 0) as legacy_total
  from (select acc_id, count(*) as n from q_ledger where side = 'sell' group by acc_id) s
  full join (select acc_id, count(*) as n from q_ledger where side = 'get' group by acc_id) g
    on s.acc_id = g.acc_id"""
NAMED["q_trade"] = f"""
  select d.*, count_sell, count_get, total_trade_count from (
    select acc_id, day,
      coalesce(sum(item_amount) filter (side = 'sell'), 0) as sell_item_amount,
      coalesce(sum(item_price) filter (side = 'sell'), 0) as sell_item_price,
      coalesce(sum(item_amount) filter (side = 'get'), 0) as get_item_amount,
      coalesce(sum(item_price) filter (side = 'get'), 0) as get_item_price,
      {_each("0123", "count(*) filter (time_bin = $c) as trade_time_bin_$c")},
      {_each("01", "count(*) filter (type = $c) as trade_type_$c")},
      sum(item_amount) as tot_trade_amount,
      coalesce(sum(item_price) filter (side = 'sell'), 0)
        - coalesce(sum(item_price) filter (side = 'get'), 0) as tot_get_money,
      1 as trade_logged_in
    from q_ledger where acc_id in (select acc_id from fx_combat) group by acc_id, day) d
  join q_counts using (acc_id)"""
NAMED["q_gross"] = """
  select *, item_amount * filled as total_item_price
  from (select *, coalesce(item_price, avg(item_price) over (partition by item_type)) as filled from q_scaled)"""
NAMED["q_both"] = """
  select source_acc_id as acc_id, 'sell' as side, * from q_gross
  union all select target_acc_id as acc_id, 'get' as side, * from q_gross"""
NAMED["q_median"] = """
  select t.*, item_amount * coalesce(item_price, med) as total_item_price, """ + BIN4 + """ as bin4
  from fx_trade t, (select median(item_price) as med from fx_trade) m"""

# --- panel -----------------------------------------------------------------
NAMED["q_panel"] = f"""
  select c.acc_id, c.day, {_each(PANEL, '"$c"')}
  from q_combat c
    left join q_pledge using (acc_id, day) left join q_trade using (acc_id, day)
    left join q_activity using (acc_id, day) left join q_payment using (acc_id, day)"""
NAMED["q_fill"] = f"""
  select k.acc_id, k.day, {_each(PANEL, 'p."$c"')}
  from (select acc_id, d.day from (select distinct acc_id from fx_combat),
          (select unnest(range(1, 29)) as day) d) k
    left join q_panel p on k.acc_id = p.acc_id and k.day = p.day"""
_named = ", ".join(f'"{c}" as "{PANEL_RENAME.get(c, c)}"' for c in PANEL)
NAMED["q_named"] = f"select acc_id, day, {_named} from q_fill"
_filled = ", ".join(
    f'coalesce("{c}", avg("{c}") over (partition by acc_id), 0) as "{c}"' if c in MEAN_FILL
    else f'coalesce("{c}", 0) as "{c}"'
    for c in IMPUTED
)
NAMED["q_imputed"] = f"select acc_id, day, {_filled} from q_named"
NAMED["q_means"] = f"""
  select acc_id, {_each(IMPUTED, 'avg("$c") as "$c"')} from q_imputed group by acc_id"""
NAMED["q_squeeze"] = "select acc_id, " + ", ".join(
    f'{"avg" if c in SQUEEZE_MEAN else "sum"}("{c}") as "{c}"' for c in IMPUTED
) + " from q_imputed group by acc_id"
NAMED["q_target"] = """
  select k.acc_id, k.day, coalesce(p.amount_spent, 0) as amount_spent
  from q_fill k left join q_payday p on k.acc_id = p.acc_id and k.day = p.day"""

# --- labels, scores --------------------------------------------------------
NAMED["q_groups"] = """
  select *, case when amount_spent = 0 then 0 when amount_spent < 0.27 then 1 else 2 end as amo_group,
    case when survival_time = 64 then 1 else 0 end as sur_group from fx_label"""
NAMED["q_score"] = """
  select acc_id, p_surv, p_spent, cost, gamma, t_k, gamma * t_k * a_spent - cost as profit from (
    select *, case when opt = 0 then 0 when cost / opt < 0.1 then 0 when cost / opt >= 1 then 1
        else cost / (0.9 * opt) - 0.1 / 0.9 end as gamma,
      case when p_surv = 64 or a_surv = 64 then 0
        else 30 * exp(-power(p_surv - a_surv, 2) / (2 * 15 * 15)) end as t_k
    from (select p.acc_id, p.survival_time as p_surv, p.amount_spent as p_spent,
            a.survival_time as a_surv, a.amount_spent as a_spent,
            case when p.survival_time = 64 then 0 else 0.01 * 30 * p.amount_spent end as cost,
            case when p.survival_time = 64 then 0 else 0.01 * 30 * a.amount_spent end as opt
          from fx_pred p join fx_label a on p.acc_id = a.acc_id))"""

# --- correlation, neighbours -----------------------------------------------
NAMED["q_labels"] = """
  select acc_id, amount_spent as label_amount_spent,
    case when survival_time = 64 then 1 else 0 end as "label_isSurvival" from fx_label"""


def _spearman(source: str, features: list[str]) -> str:
    """Average ranks per feature over the unpivoted account rows, then Pearson."""
    def ranked(c: str) -> str:
        return f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0"

    parts = []
    for f in features:
        for label in CORR_LABELS:
            parts.append(
                f"""select '{f}' as feature, '{label}' as label,
                case when stddev_pop(x) = 0 or stddev_pop(y) = 0 then null
                  else covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) end as rho
                from (select {ranked('"' + f + '"')} as x, {ranked('"' + label + '"')} as y from {source})"""
            )
    return " union all ".join(parts)


NAMED["q_account"] = f"""
  select acc_id, {_each(IMPUTED, 'round("$c", 9) + 0.0 as "$c"')}, {_each(CORR_LABELS, '"$c"')}
  from q_means join q_labels using (acc_id)"""
NAMED["q_rho"] = _spearman("q_account", IMPUTED)
NAMED["q_degree"] = """
  select acc_id, count(*) as degree
  from (select source_acc_id as acc_id from fx_trade union all select target_acc_id from fx_trade)
  group by acc_id"""
NAMED["q_partners"] = """
  select acc_id, count(distinct partner) as partners
  from (select source_acc_id as acc_id, target_acc_id as partner from fx_trade
        union all select target_acc_id, source_acc_id from fx_trade) group by acc_id"""
NAMED["q_network"] = """
  select acc_id, degree, partners, label_amount_spent, "label_isSurvival"
  from q_degree join q_partners using (acc_id) join q_labels using (acc_id)"""


def _unit(c: str, lo: str, hi: str) -> str:
    return f"coalesce(({c} - {lo}) / nullif({hi} - {lo}, 0), 0)"


NAMED["q_knn_day"] = f"""
  select acc_id, day, {_each(KNN_FEATURES, _unit('"$c"', 'lo_$c', 'hi_$c') + ' as "$c"')}
  from q_imputed,
    (select {_each(KNN_FEATURES, 'min("$c") as lo_$c, max("$c") as hi_$c')} from q_imputed) b"""


def _hash(key: str, seed: int) -> str:
    return f"((({key} % 1000003) * 7919 + {seed}) % 1000003)"


def _part(share: int) -> str:
    return f"case when {_hash('acc_id', 42)} % 1000 < {share} then 'train' else 'test' end"


_prepared = [c for c in IMPUTED if c != "amount_spent"]
NAMED["q_prep"] = f"""
  select s.acc_id, l.amount_spent as spent, {_each(_prepared, 'round(s."$c", 6) + 0.0 as "$c"')}, {_part(800)} as part
  from q_squeeze s join fx_label l using (acc_id)"""
NAMED["q_prep_train"] = "select * from q_prep where part = 'train'"
NAMED["q_prep_rho"] = " union all ".join(
    f"""select '{c}' as feature, lo, hi, case when stddev_pop(x) = 0 or stddev_pop(y) = 0 then 0
      else round(covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)), 9) end as rho
    from (select rank() over (order by "{c}") + (count(*) over (partition by "{c}") - 1) / 2.0 as x,
        rank() over (order by spent) + (count(*) over (partition by spent) - 1) / 2.0 as y,
        min("{c}") over () as lo, max("{c}") over () as hi from q_prep_train) group by lo, hi"""
    for c in _prepared)


def _vote(refs: str, asked: str, features: list[str], label: str, keys: str = "",
          differ: bool = False) -> str:
    """Brute-force nearest five and majority label, ties to the smaller."""
    gaps = " + ".join(f'(q."{f}" - r."{f}") * (q."{f}" - r."{f}")' for f in features)
    on = " and ".join([*[f"q.{k} = r.{k}" for k in keys.split()], *(["q.acc_id <> r.acc_id"] if differ else [])])
    key_list = "".join(f", {k}" for k in keys.split())
    q_keys = "".join(f", q.{k}" for k in keys.split())
    return f"""
      select acc_id{key_list}, label as prediction from (
        select acc_id{key_list}, label, row_number() over (partition by acc_id{key_list} order by n desc, label) as pick
        from (select acc_id{key_list}, label, count(*) as n from (
            select q.acc_id{q_keys}, r."{label}" as label, row_number() over (
                partition by q.acc_id{q_keys} order by round(sqrt({gaps}), 9), r.acc_id) as pos
            from {asked} q join {refs} r on {on or 'true'}) where pos <= 5
          group by acc_id{key_list}, label)) where pick = 1"""


NAMED["q_knn"] = f"""
  select acc_id, amo_group, {_each(KNN_FEATURES, 'round(avg("$c"), 9) as "$c"')}, {_part(750)} as part
  from q_knn_day join q_groups using (acc_id) group by acc_id, amo_group"""
NAMED["q_knn_train"] = "select * from q_knn where part = 'train'"
NAMED["q_knn_test"] = "select * from q_knn where part = 'test'"
NAMED["q_knn_week"] = f"""
  select acc_id, week, amo_group, {_each(KNN_FEATURES, 'round(avg("$c"), 9) as "$c"')}
  from (select *, cast(ceil(day / 7.0) as int) as week from q_knn_day) join q_groups using (acc_id)
  group by acc_id, week, amo_group"""
NAMED["q_embedding"] = "select vec_id as acc_id, label, " + ", ".join(
    f"cast(embedding[{n + 1}] as double) as e{n}" for n in range(64)
) + " from embeddings"

QUERIES: dict[str, str] = {}
Q = QUERIES

Q["scan_profile"] = " union all ".join(
    f"""select '{t}' as table_name, count(*) as n_rows,
      (select count(*) from (describe {t})) as n_columns from {t}""" for t in BASE_TABLES
)
Q["sink_roundtrip"] = Q["activity_daily"] = "select * from q_activity"
Q["combat_daily"] = "select * from q_combat"
Q["major_class"] = "select * from q_major"
Q["level_progress"] = "select * from q_levels"
Q["level_stats"] = """
  select acc_id, max(level) as maxlevel, min(level) as minlevel, sum(level) as totlevel,
    avg(level) as meanlevel from fx_combat group by acc_id"""
Q["combat_class_pivot"] = f"""
  select acc_id, day, {_each("01234567", "sum(case when class = $c then 1 else 0 end) as class_$c")}
  from fx_combat group by acc_id, day"""
Q["pledge_scores"] = "select * from q_scores"
Q["pledge_scores_accounts"] = _scores("count(distinct acc_id)")
Q["pledge_daily"] = "select * from q_pledge"
Q["payment_stats"] = f"select acc_id, {_spent.replace('$w', '')} from q_payday group by acc_id"
Q["payment_transform"] = "select * from q_payment"
Q["payment_total"] = "select acc_id, sum(amount_spent) as total_payment from fx_payment group by acc_id"
Q["total_playtime"] = "select acc_id, sum(playtime) as total_play_time from fx_activity group by acc_id"
Q["playtime_cumulative"] = """
  select acc_id, day, playtime, sum(playtime) over (partition by acc_id order by day) as cum_play_time
  from (select acc_id, day, sum(playtime) as playtime from fx_activity group by acc_id, day)"""
Q["server_rollup"] = f"""
  select server, acc_id, day, {_sums(ACTIVITY_MEASURES)} from fx_activity group by server, acc_id, day"""
Q["server_levels"] = """
  select server, acc_id, max(level) as maxlevel, avg(level) as meanlevel
  from fx_combat group by server, acc_id"""
Q["server_code_mean"] = """
  select acc_id, day, avg(code) as server_code, sum(playtime) as playtime
  from fx_activity join (select server, dense_rank() over (order by server) - 1 as code
    from (select distinct server from fx_activity)) using (server) group by acc_id, day"""

Q["time_bins"] = f"""
  select time, coalesce({BIN4}, 0) as bin4, {BIN4} as bin4_none, coalesce({BIN24}, 0) as bin24, n
  from (select time, count(*) as n from fx_trade group by time)"""
Q["evening_flag"] = f"""
  select time, case {BIN4} when 0 then 1 when 1 then 1 when 2 then 1 when 3 then 0 end as evening, n
  from (select time, count(*) as n from fx_trade group by time)"""
Q["trade_normalize"] = "select * from q_normal"
Q["trade_gross"] = "select * exclude (item_price), filled as item_price from q_gross"
Q["trade_ledger"] = "select * from q_ledger"
Q["trade_counts"] = "select * from q_counts"
Q["trade_counts_legacy"] = """
  select acc_id, count_sell, count_get, legacy_total as total_trade_count from q_counts"""


def _pivot(side: str, value: str) -> str:
    out = []
    for t in ITEMS:
        here = f"side = '{side}' and item_type = '{t}'"
        out.append(f"coalesce(sum(item_amount) filter ({here}), 0) as {side}_count_{t.lower()}")
        out.append(f"coalesce(sum({value}) filter ({here}), 0) as {side}_amount_{t.lower()}")
    return ", ".join(out)


Q["trade_item_pivot"] = f"""
  select acc_id, day, {_pivot("sell", "item_price")}, {_pivot("get", "item_price")}
  from q_ledger group by acc_id, day"""
Q["trade_daily"] = "select * from q_trade"


def _v1_side(s: str) -> str:
    return ", ".join([
        f"coalesce(sum(item_amount) filter (side = '{s}'), 0) as {s}_item_amount",
        f"coalesce(sum(filled) filter (side = '{s}'), 0) as {s}_item_price",
        f"coalesce(sum(total_item_price) filter (side = '{s}'), 0) as total_{s}_item_price",
        _pivot(s, "total_item_price"),
        *[f"count(*) filter (side = '{s}' and item_type = '{t}') as {s}_item_type_{n}"
          for n, t in enumerate(ITEMS)],
        *[f"count(*) filter (side = '{s}' and coalesce(bin24, 0) = {b}) as {s}_time_bin_{b}"
          for b in range(24)],
        *[f"count(*) filter (side = '{s}' and type = {v}) as {s}_type_{v}" for v in (0, 1)],
    ])


_names = [t.lower() for t in ITEMS]
Q["trade_daily_v1"] = f"""
  select *, {_each([f"amount_{n}" for n in _names] + ["item_amount"], "sell_$c - get_$c as tot_$c")},
    {_each([f"count_{n}" for n in _names] + [f"item_type_{n}" for n in range(len(ITEMS))]
           + [f"time_bin_{b}" for b in range(24)], "sell_$c + get_$c as tot_$c")},
    1 as trade_logged_in
  from (select acc_id, day, {_v1_side("sell")}, {_v1_side("get")}
        from q_both where acc_id in (select acc_id from fx_combat) group by acc_id, day)"""
Q["trade_daily_v0"] = f"""
  select acc_id, day, sum(total_item_price) as total_item_price,
    {_each("0123", "count(*) filter (bin4 = $c) as time_bin_$c")},
    {_each("01", "count(*) filter (type = $c) as type_$c")}
  from (select source_acc_id as acc_id, * from q_median
        union all select target_acc_id as acc_id, * from q_median)
  where acc_id in (select acc_id from fx_combat) group by acc_id, day"""
Q["trade_type_mean"] = """
  select source_acc_id as acc_id, day, avg(type) as type,
    coalesce(sum(case when bin4 = 3 then 0 when bin4 in (0, 1, 2) then 1 end), 0) as time_bin,
    sum(total_item_price) as total_item_price
  from q_median group by source_acc_id, day"""
Q["both_sided_days"] = """
  select s.acc_id, s.day, s.n as n_sell, g.n as n_get
  from (select source_acc_id as acc_id, day, count(*) as n from fx_trade group by 1, 2) s
  join (select target_acc_id as acc_id, day, count(*) as n from fx_trade group by 1, 2) g
    on s.acc_id = g.acc_id and s.day = g.day"""
Q["item_price_mean"] = "select item_type, avg(item_price) as mean_price from q_scaled group by item_type"
Q["account_trade_value"] = f"""
  select source_acc_id as acc_id, sum(case when item_type = '{MONEY}' then item_amount else 0 end) as money_amount,
    sum(item_amount) as all_amount, coalesce(sum(item_price), 0) as all_price
  from fx_trade group by source_acc_id"""

Q["panel_join"] = "select * from q_panel"
_stats = PAYMENT_STATS
Q["panel_join_union"] = f"""
  select acc_id, day, {_each([c for c in PANEL if c not in _stats], '"$c"')},
    {_each(_stats, 'max("$c") over (partition by acc_id) as "$c"')}
  from (select acc_id, day from q_combat union select acc_id, day from q_pledge
        union select acc_id, day from q_trade union select acc_id, day from q_activity
        union select acc_id, day from q_payment) k
    left join q_combat using (acc_id, day) left join q_pledge using (acc_id, day)
    left join q_trade using (acc_id, day) left join q_activity using (acc_id, day)
    left join q_payment using (acc_id, day)"""
Q["panel_fill28"] = "select * from q_fill"
Q["rename_prefix"] = f"select acc_id, day, {_named} from q_panel"
Q["panel_impute"] = "select * from q_imputed"
Q["presence_flags"] = "select acc_id, day, " + _each(
    ["combat_logged_in", "pledge_logged_in", "trade_logged_in", "activity_logged_in", "payment_logged_in"],
    "coalesce($c, 0) as $c") + " from q_fill"
Q["panel_slice"] = f"select * from q_imputed order by acc_id, day limit {SLICE[1]} offset {SLICE[0]}"
Q["played_flag"] = """
  select *, case when a_playtime <> 0 then 1 else 0 end as isplayed from q_imputed"""
Q["account_squeeze"] = "select * from q_squeeze"
Q["account_mean"] = "select * from q_means"
Q["week_mean"] = f"""
  select acc_id, case when day < 8 then 1 when day < 15 then 2 when day < 22 then 3 else 4 end as week,
    {_each(IMPUTED, 'avg("$c") as "$c"')} from q_imputed group by 1, 2"""
Q["daily_target"] = "select * from q_target"
Q["daily_target_mean"] = """
  select k.acc_id, k.day, coalesce(p.amount_spent, m.mean_spent, 0) as amount_spent
  from q_fill k left join q_payday p on k.acc_id = p.acc_id and k.day = p.day
    left join (select acc_id, avg(amount_spent) as mean_spent from q_payday group by acc_id) m
      on k.acc_id = m.acc_id"""

Q["account_sequence"] = "select * from q_imputed"
_days = ", ".join(f"'{c}': {c}" for c in ["day", *IMPUTED])
Q["sliding7"] = f"""
  select acc_id, start, s.* from (select acc_id, start, unnest(w) as s from (
    select acc_id, day as start, list({{{_days}}}) over (partition by acc_id order by day
      rows between current row and 6 following) as w from q_imputed) where len(w) = 7)"""
Q["sliding7_target"] = f"""
  select acc_id, start, s.*, y from (select acc_id, start, y, unnest(w) as s from (
    select acc_id, day as start, list({{{_days}}}) over (partition by acc_id order by day
      rows between current row and 6 following) as w,
      lead(amount_spent, 7) over (partition by acc_id order by day) as y from q_imputed) where len(w) = 7 and y is not null)"""
def _next(window: str, at: int = 0) -> str:
    """The window model's next value after ``window`` (a list)."""
    return " + ".join([str(WINDOW_WEIGHTS[0]), *[f"{w} * {window}[{at + k + 1}]" for k, w in enumerate(WINDOW_WEIGHTS[1])]])


def _rollout(series: str) -> str:
    return f"""(with recursive roll as (
        select acc_id, len(y) as n, y[-7:] as w, list_sum(y) as total, len(y) as day from {series}
        union all
        select acc_id, n, list_append(w[2:], ahead), total + ahead, day + 1
        from (select *, {_next("w")} as ahead from roll where day < 64))
      select acc_id, n, w[7] as last_value, total / 64 as mean_value from roll where day = 64)"""


Q["window_forecast"] = f"""
  with s as (select acc_id, list(cast(amount_spent as double) order by day) as y from q_target group by acc_id),
  p as (select acc_id, list_transform(range(1, len(y) + 1), lambda i: case when i <= 7 then y[i]
    else {" + ".join([str(WINDOW_WEIGHTS[0]), *[f"{w} * y[i - {7 - k}]" for k, w in enumerate(WINDOW_WEIGHTS[1])]])} end) as y from s)
  select k.acc_id, k.n as n_known, k.last_value, k.mean_value, f.last_value as fed_last, f.mean_value as fed_mean
  from {_rollout("s")} k join {_rollout("p")} f using (acc_id)"""
Q["ar_forecast"] = """
  with pairs as (select acc_id, day, amount_spent as y,
      lag(amount_spent) over (partition by acc_id order by day) as x from q_target),
  stats as (select acc_id, sum(y) as sum_y, avg(y) as mean_y, max(case when day = 28 then y end) as last_y,
      count(x) as n, avg(x) as mx, avg(case when x is not null then y end) as my,
      avg(x * x) - avg(x) * avg(x) as vx,
      avg(x * y) - avg(x) * avg(case when x is not null then y end) as cxy from pairs group by acc_id),
  fit as (select acc_id, sum_y, last_y, case when vx <= 1e-9 then 0 else cxy / vx end as slope,
      case when vx <= 1e-9 then mean_y else my - cxy / vx * mx end as intercept from stats)
  select acc_id, slope, intercept, (sum_y + ahead) / 64 as mean_spend
  from fit join (select acc_id, sum(power(slope, h) * last_y
      + intercept * (1 - power(slope, h)) / (1 - slope)) as ahead
    from fit, (select unnest(range(1, 37)) as h) group by acc_id) using (acc_id)"""

Q["label_totals"] = "select *, survival_time * amount_spent as total_spent from fx_label"
Q["label_groups"] = "select * from q_groups"
Q["group_sizes"] = "select amo_group, sur_group, count(*) as n from q_groups group by amo_group, sur_group"
Q["label_onehot"] = f"""
  select acc_id, amount_spent, {_each([str(t) for t in range(1, 65)], "case when survival_time = $c then 1 else 0 end as st_$c")}
  from fx_label"""
Q["log_spend"] = """
  select *, case when max_spent = 0 then 0 else ln(nullif(max_spent, 0)) end as log_max_spent from q_imputed"""
Q["nonzero_spend"] = "select * from fx_label where amount_spent <> 0"
Q["route_by_group"] = """
  select p.*, g.sur_group from q_imputed p join q_groups g using (acc_id) where sur_group = 1"""
Q["score_keycheck"] = """
  select coalesce(c.acc_id, l.acc_id) as acc_id, case when c.acc_id is null then 0 else 1 end as in_pred,
    case when l.acc_id is null then 0 else 1 end as in_actual
  from (select distinct acc_id from fx_combat) c full join fx_label l on c.acc_id = l.acc_id
  where c.acc_id is null or l.acc_id is null"""
Q["score_profit"] = "select sum(profit) as score from q_score"
Q["score_per_account"] = "select * from q_score"
Q["score_by_group"] = """
  select case when p_spent = 0 then 0 when p_spent < 0.27 then 1 else 2 end as amo_group,
    case when p_surv = 64 then 1 else 0 end as sur_group, count(*) as n, sum(profit) as profit
  from q_score group by 1, 2"""
Q["metric_accuracy"] = """
  select count(*) as n, count(distinct p.survival_time) as n_predicted_labels,
    avg(case when p.survival_time = a.survival_time then 1.0 else 0.0 end) as accuracy
  from fx_pred p join fx_label a on p.acc_id = a.acc_id"""
Q["metric_regression"] = """
  select avg(power(p.amount_spent - a.amount_spent, 2)) as mse,
    1 - sum(power(p.amount_spent - a.amount_spent, 2)) / sum(power(a.amount_spent - m.mean, 2)) as r2
  from fx_pred p join fx_label a on p.acc_id = a.acc_id, (select avg(amount_spent) as mean from fx_label) m"""

Q["labelled_only"] = """
  select * from fx_trade where source_acc_id in (select acc_id from fx_label)
    and target_acc_id in (select acc_id from fx_label)"""
Q["point_lookup"] = f"select * from fx_combat where acc_id = {LOOKUP_ACCOUNT}"
_chars = """(select acc_id, char_id from fx_combat union all select acc_id, char_id from fx_pledge
  union all select acc_id, char_id from fx_activity)"""
Q["char_count"] = f"select acc_id, count(distinct char_id) as char_count from {_chars} group by acc_id"
Q["char_count_sketch"] = Q["char_count"]
Q["char_rows"] = f"select char_id, count(*) as n_rows from {_chars} group by char_id"
Q["char_totals"] = f"""
  select count(distinct acc_id) as n_accounts, count(distinct char_id) as n_chars from {_chars}"""
Q["server_list"] = """
  select server from fx_combat union select server from fx_trade union select server from fx_activity
  union select server from fx_pledge"""
Q["value_counts"] = "select class, count(*) as n from fx_combat group by class"
Q["label_encode"] = " union all ".join(
    f"""select {c} as value, dense_rank() over (order by {c}) - 1 as code, '{c}' as source
      from (select distinct {c} from fx_trade)""" for c in ("item_type", "server")
)
_trade_columns = ["day", "time", "type", "server", "source_acc_id", "source_char_id",
                  "target_acc_id", "target_char_id", "item_type", "item_amount", "item_price"]
Q["null_profile"] = " union all ".join(
    f"select 'column' as scope, '{c}' as name, count(*) - count({c}) as nulls, count({c}) as non_nulls from fx_trade"
    for c in _trade_columns
) + """ union all select 'item_price by item_type', item_type, count(*) - count(item_price), count(item_price)
  from fx_trade group by item_type"""
Q["describe_label"] = " union all ".join(
    f"""select '{c}' as feature, count({c}) as n, avg({c}) as mean, stddev_samp({c}) as std,
      min({c}) as min, max({c}) as max, quantile_cont(cast({c} as double), 0.25) as q25,
      quantile_cont(cast({c} as double), 0.5) as q50, quantile_cont(cast({c} as double), 0.75) as q75
      from fx_label""" for c in ("survival_time", "amount_spent")
)
Q["spend_concentration"] = """
  select t / 20.0 as threshold, sum(case when amount_spent > t / 20.0 then amount_spent else 0 end) / sum(amount_spent) as ratio,
    sum(case when amount_spent < t / 20.0 then amount_spent else 0 end) as down,
    sum(case when amount_spent > t / 20.0 then amount_spent else 0 end) as upper,
    count(*) filter (amount_spent > t / 20.0) as "count",
    count(*) filter (amount_spent > t / 20.0) / count(*) as cratio
  from fx_label, (select unnest(range(1, 20)) as t) group by t"""


def _histogram(source: str, cols: list[str], bins: int) -> str:
    parts = []
    for c in cols:
        width = f"((hi - lo) / {bins})"
        at = f"least(coalesce(floor((x - lo) / nullif({width}, 0)), 0), {bins - 1})"
        parts.append(
            f"""select '{c}' as feature, {at} as bin,
              any_value(lo) + {at} * (any_value(hi) - any_value(lo)) / {bins}.0 as lower, count(*) as n
            from (select cast("{c}" as double) as x from {source}),
              (select min(cast("{c}" as double)) as lo, max(cast("{c}" as double)) as hi from {source})
            group by {at}"""
        )
    return " union all ".join(parts)


Q["histogram"] = _histogram("fx_label", ["survival_time", "amount_spent"], 40)
NAMED["q_rounded"] = f"""
  select {_each(IMPUTED, 'round(cast("$c" as double), 6) as "$c"')} from q_imputed"""
Q["feature_histogram"] = _histogram("q_rounded", IMPUTED, 20)
Q["spend_by_survival"] = """
  select survival_time, avg(amount_spent) as mean_spent, count(*) as n from fx_label group by survival_time"""
Q["records_per_spend"] = "select amount_spent, count(*) as n from fx_label group by amount_spent"
Q["zero_share"] = """
  select count(*) filter (amount_spent = 0) as n_zero, count(*) as n,
    count(*) filter (amount_spent = 0) / count(*) as zero_share from q_target"""

_with_bin = "(select *, coalesce(bin4, 0) as time_bin from q_normal)"
Q["corr_pearson"] = " union all ".join(
    f"""select '{a}' as left_column, '{b}' as right_column,
      case when stddev_pop(x) = 0 or stddev_pop(y) = 0 then null
        else covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) end as corr
      from (select cast({a} as double) as x, cast({b} as double) as y from {_with_bin}
            where {a} is not null and {b} is not null)"""
    for n, a in enumerate(TRADE_CORR) for b in TRADE_CORR[n:]
)
Q["corr_spearman"] = "select * from q_rho"
Q["feature_select"] = """
  select * from q_rho
  where abs(rho) >= case label when 'label_amount_spent' then 0.3 else 0.1 end"""
Q["top_features"] = """
  select label, place, feature, rho from (select label, feature, rho,
    row_number() over (partition by label order by round(abs(rho), 9) desc nulls last, feature) as place from q_rho)
  where place <= 10"""
Q["minmax_scale"] = f"""
  select acc_id, {_each(IMPUTED, _unit('"$c"', "lo_$c", "hi_$c") + ' as "$c"')}
  from q_squeeze, (select {_each(IMPUTED, 'min("$c") as lo_$c, max("$c") as hi_$c')}
    from (select *, {_part(800)} as part from q_squeeze) where part = 'train') b"""
Q["standard_minmax"] = f"""
  with z as (select acc_id, {_each(IMPUTED, 'coalesce(("$c" - m_$c) / nullif(s_$c, 0), 0) as "$c"')}
    from q_squeeze, (select {_each(IMPUTED, 'avg("$c") as m_$c, stddev_pop("$c") as s_$c')} from q_squeeze) b)
  select acc_id, {_each(IMPUTED, _unit('"$c"', "lo_$c", "hi_$c") + ' as "$c"')}
  from z, (select {_each(IMPUTED, 'min("$c") as lo_$c, max("$c") as hi_$c')} from z) b"""
Q["prepared_ranges"] = f"""
  select feature, rho, case when abs(rho) >= {PREPARED_MIN_CORR} then 1 else 0 end as kept,
    case when abs(rho) >= {PREPARED_MIN_CORR} then lo end as low, case when abs(rho) >= {PREPARED_MIN_CORR} then hi end as high
  from q_prep_rho"""
Q["prepared_features"] = f"""
  select acc_id, feature, {_unit("x", "lo", "hi")} as value
  from (unpivot (select * exclude (spent, part) from q_prep where part = 'test')
    on columns(* exclude acc_id) into name feature value x)
  join q_prep_rho using (feature) where abs(rho) >= {PREPARED_MIN_CORR}"""
Q["prediction_table"] = "select * from q_score"
Q["split_by_key"] = f"select acc_id, {_part(800)} as part from fx_label"
Q["sample_accounts"] = f"""
  select acc_id from (select distinct acc_id from fx_combat)
  order by {_hash("acc_id", 11)}, acc_id limit 15"""

Q["trade_edges"] = "select distinct source_acc_id as src, target_acc_id as dst from fx_trade"
Q["trade_degree"] = "select * from q_degree"
Q["hub_edges"] = f"""
  select distinct source_acc_id as src, target_acc_id as dst from fx_trade
  where source_acc_id in (select acc_id from q_degree where degree > {HUB_DEGREE})"""
Q["trader_id_sets"] = """
  select acc_id, case when acc_id in (select source_acc_id from fx_trade) then 1 else 0 end as is_seller,
    case when acc_id in (select target_acc_id from fx_trade) then 1 else 0 end as is_buyer
  from (select distinct acc_id from fx_combat)
  where acc_id in (select source_acc_id from fx_trade) or acc_id in (select target_acc_id from fx_trade)"""
Q["trader_labels"] = """
  select acc_id, survival_time, amount_spent from fx_label
  where acc_id in (select source_acc_id from fx_trade) and acc_id in (select target_acc_id from fx_trade)
    and acc_id in (select acc_id from fx_combat)"""
Q["subset_accounts"] = f"select acc_id, survival_time, amount_spent from fx_label where {_hash('acc_id', 7)} % 1000 < 250"
NAMED["q_pairs"] = """
  select distinct least(source_acc_id, target_acc_id) as a, greatest(source_acc_id, target_acc_id) as b
  from fx_trade where source_acc_id <> target_acc_id"""
NAMED["q_ways"] = "select a as src, b as dst from q_pairs union all select b, a from q_pairs"
NAMED["q_nodes"] = "select src as acc_id, count(*) as partners, count(*) over () as n from q_ways group by src"
NAMED["q_rank0"] = "select acc_id, cast(1.0 as double) / n as r from q_nodes"
for _step in range(1, 11):
    NAMED[f"q_rank{_step}"] = f"""
      select v.acc_id, 0.15 / v.n + 0.85 * s.got as r from q_nodes v join (
        select w.dst as acc_id, sum(k.r / u.partners) as got
        from q_ways w join q_rank{_step - 1} k on k.acc_id = w.src join q_nodes u on u.acc_id = w.src group by w.dst) s using (acc_id)"""
NAMED["q_triangles"] = """
  select acc_id, count(*) as triangles from (select unnest([x.a, x.b, y.b]) as acc_id
    from q_pairs x join q_pairs y on x.b = y.a join q_pairs z on z.a = x.a and z.b = y.b) group by acc_id"""
NAMED["q_measures"] = """
  select v.acc_id, partners, coalesce(triangles, 0) as triangles,
    coalesce(2.0 * coalesce(triangles, 0) / nullif(partners * (partners - 1), 0), 0) as clustering, r as pagerank
  from q_nodes v left join q_triangles t on t.acc_id = v.acc_id join q_rank10 k on k.acc_id = v.acc_id"""
NAMED["q_measured"] = """
  select m.* replace (round(clustering, 9) as clustering, round(pagerank, 9) as pagerank), label_amount_spent, "label_isSurvival"
  from q_measures m join q_labels using (acc_id)"""
Q["network_measures"] = "select * from q_measures"
Q["network_label_corr"] = _spearman("q_measured", ["partners", "triangles", "clustering", "pagerank"])
Q["degree_label_corr"] = _spearman("q_network", ["degree", "partners"])

Q["knn_vote"] = _vote("q_knn_train", "q_knn_test", KNN_FEATURES, "amo_group")
Q["knn_weekly"] = f"""
  select acc_id, mean_vote, case when mean_vote < 1 then 0 when mean_vote < 2 then 1 else 2 end as prediction
  from (select acc_id, avg(prediction) as mean_vote
        from ({_vote("q_knn_week", "q_knn_week", KNN_FEATURES, "amo_group", "week")}) group by acc_id)"""
Q["knn_embedding"] = _vote("q_embedding", "q_embedding", [f"e{n}" for n in range(64)], "label", differ=True)

NAMED["q_servers"] = """
  select server, count(*) as n_accounts, avg(survival_time) as mean_survival, avg(amount_spent) as mean_spent,
    rank() over (order by round(avg(survival_time), 9) desc) as survival_rank,
    rank() over (order by round(avg(amount_spent), 9) desc) as spend_rank
  from (select distinct server, acc_id from fx_activity) join fx_label using (acc_id) group by server"""
Q["server_rank"] = "select * from q_servers"
_index = ["game_money_change", "private_shop", "fishing", "enchant_count", "playtime"]
Q["activity_index"] = f"""
  select acc_id, day, {_each(_index, _unit("$c", "lo_$c", "hi_$c"), " + ")} as activity_index
  from q_activity, (select {_each(_index, "min($c) as lo_$c, max($c) as hi_$c")} from q_activity) b"""
Q["attack_kill"] = """
  select acc_id, day, c.random_attacker_cnt * a.npc_kill as attack_kill
  from q_combat c join q_activity a using (acc_id, day)"""
Q["attack_top_server"] = """
  select acc_id, sum(random_attacker_cnt) as top_server_attacks from fx_combat
  where server = (select min(server) from q_servers where spend_rank = 1) group by acc_id"""
Q["class_cohort"] = """
  select class, count(*) as n_accounts, avg(amount_spent) as mean_spent,
    count(*) filter (lv <= 50) as n_low, avg(amount_spent) filter (lv <= 50) as mean_spent_low,
    avg(days) filter (lv <= 50) as mean_days_low
  from (select class, acc_id, max(level) as lv, count(distinct day) as days
        from fx_combat where class in (1, 2, 3, 7) group by class, acc_id)
  join fx_label using (acc_id) group by class"""
Q["death_rate"] = "select acc_id, day, death / nullif(playtime, 0) as death_per_playtime from q_activity"
Q["boss_hits"] = "select acc_id, sum(rich_monster) as boss_hits from fx_activity group by acc_id"


def _top(c: str, source: str, bins: int = 3) -> str:
    return f"""least(floor(({c} - (select min({c}) from {source}))
      / (((select max({c}) from {source}) - (select min({c}) from {source})) / {bins})), {bins - 1}) = {bins - 1}"""


NAMED["q_totals"] = """
  select acc_id, sum(game_money_change) as money, sum(enchant_count) as enchant, sum(playtime) as playtime
  from fx_activity group by acc_id"""
Q["top_bin_cohort"] = f"""
  select t.acc_id, survival_time, money, enchant, amount_spent
  from q_totals t left join fx_label l on t.acc_id = l.acc_id
  where {_top("money", "q_totals", 2)} and {_top("enchant", "q_totals", 2)}"""
Q["heavy_traders"] = f"""
  select acc_id, playtime from q_totals where {_top("playtime", "q_totals")}
    and (acc_id in (select source_acc_id from fx_trade) or acc_id in (select target_acc_id from fx_trade))"""
Q["pledge_co_trade"] = """
  with present as (select distinct p.pledge_id, p.acc_id, p.day, l.time_bin
    from fx_pledge p join q_ledger l on p.acc_id = l.acc_id and p.day = l.day)
  select acc_id, day, max(case when exists (select 1 from present o where o.pledge_id = t.pledge_id
      and o.day = t.day and o.time_bin = t.time_bin and o.acc_id <> t.acc_id) then 1 else 0 end) as co_trade
  from present t group by acc_id, day"""
Q["combat_trade_day"] = """
  select traded, count(*) as n_days, coalesce(sum(amount_spent), 0) as tot_spent,
    avg(coalesce(amount_spent, 0)) as mean_spent, count(*) filter (amount_spent > 0) as n_paid_days
  from (select c.acc_id, c.day, case when t.acc_id is null then 0 else 1 end as traded, p.amount_spent
        from (select distinct acc_id, day from fx_combat) c
          left join (select distinct acc_id, day from q_ledger) t on c.acc_id = t.acc_id and c.day = t.day
          left join q_payday p on c.acc_id = p.acc_id and c.day = p.day)
  group by traded"""
Q["pledge_strength"] = """
  select pledge_id, sum(combat_char_cnt) as combat_char_cnt,
    sum(combat_char_cnt) / nullif(cast(sum(pledge_combat_cnt) as double), 0) as char_per_combat,
    sum(same_pledge_cnt) / nullif(cast(sum(combat_char_cnt) as double), 0) as same_pledge_per_char,
    cast(sum(combat_play_time) as double) / nullif(cast(sum(combat_char_cnt) as double), 0) as combat_time_per_char
  from fx_pledge group by pledge_id"""
Q["nontemp_combat"] = """
  select acc_id, day, sum(pledge_cnt + random_attacker_cnt + random_defender_cnt + same_pledge_cnt + etc_cnt)
    as non_temp_cnt from fx_combat group by acc_id, day"""


def _needed(text: str, seen: list[str]) -> list[str]:
    """Names ``text`` refers to, each after the names it needs itself."""
    for name in NAMED:
        if name not in seen and re.search(rf"\b{name}\b", text):
            _needed(NAMED[name], seen)
            seen.append(name)
    return seen


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in QUERIES.items():
        chain = ", ".join(f"{n} as ({NAMED[n]})" for n in _needed(body, []))
        final = shape_sql(body, SPECS[name])
        out[name] = f"with {chain} {final}" if chain else final
    return out
