"""The same results in plain SQL, for DuckDB over the same tables.

Nothing is shared with the package: quotas, priorities, quantiles and reports
are spelled out again, mostly by the plainest route (one window per stratum,
``quantile_cont``), so that agreement means something.
"""

from __future__ import annotations

ORDERS_NULLS = """(select *, nullif(o_orderpriority, '4-NOT SPECIFIED') as priority from orders)"""
DOC = ["lang", "source"]
ORDER = ["o_orderstatus", "o_orderpriority"]
CUSTOMER = ["c_mktsegment", "c_nationkey"]
PART = ["p_brand", "p_type", "p_size"]
LINE = ["l_returnflag", "l_linestatus"]
LINE_IDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def md5_of(seed: int, ids: list[str]) -> str:
    parts = " || '|' || ".join(f"coalesce(cast({c} as varchar), '__NA__')" for c in ids)
    return f"md5('{seed}|' || {parts})"


def position(share: str) -> str:
    """The leading digits of the md5 hash at a share of its range."""
    return f"lpad(lower(to_hex(cast(floor({share}::double * {16**13}) as bigint))), 13, '0')"


def pct_take(pct: float, floor: int = 0) -> str:
    return f"least(greatest({floor}, cast(round_even(pop_n * cast({pct} as double), 0) as bigint)), pop_n)"


def ranked(source: str, strata: list[str], ids: list[str], seed: int = 42, key: str = "h") -> str:
    by = ", ".join(strata)
    return f"""(select *, count(*) over (partition by {by}) as pop_n,
        row_number() over (partition by {by} order by {key}, {", ".join(ids)}) as rn
        from (select *, {md5_of(seed, ids)} as h from {source} as src) as hashed) as ranked"""


def sample(source, strata, ids, take, columns, seed=42, key="h") -> str:
    return f"select {', '.join(columns)} from {ranked(source, strata, ids, seed, key)} where rn <= {take}"


DOC_SAMPLE = f"({sample('documents', DOC, ['doc_id'], pct_take(0.1, 1), ['doc_id', 'lang', 'source', 'n_chars'])})"


def long_levels(source: str, columns: list[str], extra: str) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", coalesce(cast({c} as varchar), '__NA__') as level, {extra} from {source} as s"""
        for c in columns
    )


def compared(population: str, drawn: str, columns: list[str], weight: str = "1") -> str:
    return f"""(
      select "column", level, pn, sn,
             cast(pn as double) / sum(pn) over (partition by "column") as pop_pct,
             cast(sn as double) / sum(sn) over (partition by "column") as samp_pct
      from (select "column", level, sum(p) as pn, sum(s) as sn from (
              {long_levels(population, columns, "1 as p, 0 as s")} union all
              {long_levels(drawn, columns, f"0 as p, {weight} as s")}) as u
            group by "column", level) as c) as compared"""


def rounded(value: str, digits: int) -> str:
    scale = 10**digits
    return f"floor(cast({value} as double) * {scale} + 0.5) / {scale}"


THREE = "case when d < 2 then 'OK' when d < 5 then 'WATCH' else 'DRIFT' end"
TWO = "case when d < 5 then 'OK' else 'DRIFT' end"


def report(population: str, drawn: str, columns: list[str], digits: int, status: str, weight: str = "1") -> str:
    return f"""select "column", level, pop_pct, samp_pct, d as abs_diff_pct, {status} as status
        from (select *, {rounded("abs(pop_pct - samp_pct) * 100", digits)} as d
              from {compared(population, drawn, columns, weight)}) as t"""


def summary(of: str, limit: float) -> str:
    return f"""select count(*) as n_levels, max(abs_diff_pct) as max_drift_pct,
        {rounded("avg(abs_diff_pct)", 4)} as mean_drift_pct,
        cast(sum(case when abs_diff_pct >= 5 then 1 else 0 end) as bigint) as n_drifted,
        case when max(abs_diff_pct) < {limit} then 'PASS' else 'REVIEW' end as verdict from ({of}) as r"""


def boosted(when: str) -> str:
    take = f"case when {when} then pop_n else {pct_take(0.1, 1)} end"
    return f"""(select doc_id, lang, source,
        (cast({take} as double) / pop_n) / cast(0.1 as double) as sampling_weight,
        cast(pop_n as double) / ({take}) as design_weight
        from {ranked('documents', DOC, ['doc_id'])} where rn <= {take})"""


LANG_LEVELS = """(select lang, count(*) as n, cast(count(*) as double) / (select count(*) from documents) as pct
                  from documents group by lang)"""
MERGED_DOCS = f"""(select d.doc_id, d.source, d.n_chars, d.lang as lang_original,
    case when l.pct < 0.14 then 'Other' else d.lang end as lang
    from documents d join {LANG_LEVELS} l on d.lang = l.lang)"""
MERGED_SAMPLE = f"({sample(MERGED_DOCS, DOC, ['doc_id'], pct_take(0.1, 1), ['doc_id', 'lang', 'lang_original', 'source'])})"


def merged_by_count(table: str, key: str, column: str, limit: int) -> str:
    return f"""select t.{key}, t.{column} as {column}_original,
        case when c.n >= {limit} then cast(t.{column} as varchar) else 'Other' end as {column}
        from {table} t join (select {column}, count(*) as n from {table} group by {column}) c
        on t.{column} = c.{column}"""


def decile(column: str, k: int, source: str) -> str:
    return f"(select {rounded(f'quantile_cont({column}, {k / 10})', 2)} from {source} as q)"


def bucket(value: str, column: str, source: str) -> str:
    steps = " ".join(
        f"when {value} < {decile(column, k + 1, source)} then cast({k / 10} as double)" for k in range(1, 9)
    )
    return f"case {steps} else cast(0.9 as double) end"


def clipped(columns: list[str], keep: list[str], source: str) -> str:
    cut = ", ".join(f"least({c}, (select quantile_cont({c}, 0.99) from {source})) as {c}" for c in columns)
    return f"(select {', '.join(keep)}, {cut} from {source})"


def cells(columns: list[str]) -> str:
    source = clipped(columns, LINE_IDS, "lineitem")
    return "(select *, " + ", ".join(
        f"{bucket(c, c, source)} as bucket_{c}" for c in columns
    ) + f" from {source} as w)"


def long_numbers(columns: list[str], table: str, what: str) -> str:
    return " union all ".join(what.format(c=c, t=table) for c in columns)


def total_take(source: str, strata: list[str], total: int) -> str:
    """Whole rows per stratum, and one more for the largest remainders."""
    by, ends = ", ".join(strata), ", ".join(f"{c} nulls first" for c in strata)
    return f"""(select {by}, base + case when place <= asked - sum(base) over () then 1 else 0 end as n_take from (
        select *, pop_n * asked // n_rows as base,
            row_number() over (order by pop_n * asked % n_rows desc, {ends}) as place
        from (select *, sum(pop_n) over () as n_rows, least({total}, sum(pop_n) over ()) as asked
              from (select {by}, count(*) as pop_n from {source} group by {by}) as c) as t) as r)"""


def total_sample(source: str, strata: list[str], ids: list[str], total: int, columns: list[str]) -> str:
    same = " and ".join(f"t.{c} is not distinct from r.{c}" for c in strata)
    listed = ", ".join(f"r.{c}" for c in columns)
    return f"select {listed} from {ranked(source, strata, ids)} as r join {total_take(source, strata, total)} as t on {same} where rn <= n_take".replace(
        ") as ranked as r", ") as r"
    )


def bounded_take(source: str, strata: list[str], total: int | str, low: str, high: str) -> str:
    """Rows per stratum between two bounds: the share at which they sum to the
    total lies behind the last bound, as a share of its stratum, that it reaches."""
    by, ends = ", ".join(strata), ", ".join(f"{c} nulls first" for c in strata)
    return f"""(with sizes as (
        select *, {low} as lo, {high} as hi from (select {by}, count(*) as pop_n from {source} group by {by}) as c
    ), bounds as (
        select lo / pop_n as share from sizes union select hi / pop_n from sizes union select 0
    ), reached as (
        select max(share) as share from (
            select share, sum(greatest(lo, least(hi, share * pop_n))) as given from bounds, sizes group by share) as g
        where given <= {total} + 1e-6
    ), marked as (
        select s.*, case when lo / pop_n > share then lo when hi / pop_n <= share then hi end as held from sizes as s, reached
    ), parts as (
        select *, {total} - sum(held) over () as rest, sum(case when held is null then pop_n end) over () as free from marked
    ), based as (
        select *, coalesce(held, pop_n * rest // free) as base, case when held is null then pop_n * rest % free end as part from parts
    )
    select {by}, base + case when part is not null and row_number() over (order by part desc nulls last, {ends})
        <= {total} - sum(base) over () then 1 else 0 end as n_take from based)"""


def taken_sample(source: str, strata: list[str], ids: list[str], take: str, columns: list[str]) -> str:
    same = " and ".join(f"t.{c} is not distinct from r.{c}" for c in strata)
    listed = ", ".join(f"r.{c}" for c in columns)
    return f"select {listed} from (select * from {ranked(source, strata, ids)}) as r join {take} as t on {same} where rn <= n_take"


def collapsed(source: str, key: str, strata: list[str], least: int) -> str:
    """Strata under ``least`` rows, merged from the last column on."""
    steps, by = [], ", ".join(strata)
    steps.append(f"level_{len(strata)} as (select {by}, count(*) as n from {source} group by {by})")
    for k in range(len(strata) - 1, 0, -1):
        above = ", ".join(strata[:k])
        steps.append(f"level_{k} as (select {above}, sum(n) as n from level_{k + 1} where n < {least} group by {above})")
    def enough(k: int) -> str:
        same = " and ".join(f"l.{c} is not distinct from s.{c}" for c in strata[:k])
        return f"exists (select 1 from level_{k} as l where {same} and l.n >= {least})"
    depth = "case " + " ".join(f"when {enough(k)} then {k}" for k in range(len(strata), 0, -1)) + " else 0 end"
    steps.append(f"placed as (select {key}, {by}, {depth} as depth from {source} as s)")
    shown = ", ".join(f"case when depth <= {i} then 'Other' else {c}::varchar end as {c}, {c} as {c}_original" for i, c in enumerate(strata))
    return f"with {', '.join(steps)} select {key}, {shown} from placed"


def statements() -> dict[str, str]:
    doc_cols, line_cols = ["doc_id", *DOC], [*LINE_IDS, "l_extendedprice", *LINE]
    nulls = ["o_orderstatus", "priority"]
    weight_key = (
        "-ln(1 - cast(('0x' || substr(h, 1, 13)) as bigint) / 4503599627370496.0::double) / o_totalprice"
    )
    doc_sizes = "(select lang, source, count(*) as pop_n from documents group by all)"
    part_sizes = "(select p_brand, p_type, p_size, count(*) as pop_n from part group by all)"
    raw = "cast(round_even(pop_n * cast(0.1 as double), 0) as bigint)"
    events = "(select event_id, event_type, event_id // 1000 as chunk_id from events)"
    halves = [
        f"""select event_id, user_id, event_type, '{label}' as period, {turn} as turn, h
            from {ranked(f"(select * from events where {when})", ["event_type"], ["event_id"])}
            where rn <= {pct_take(0.1)}"""
        for turn, (label, when) in enumerate((("first", "day(ts) <= 15"), ("second", "day(ts) > 15")))
    ]
    two_periods = f"""(select event_id, user_id, event_type, period from (select *,
        row_number() over (partition by user_id order by turn, h, event_id) as first_row
        from ({" union all ".join(halves)}) as u) as f where first_row = 1)"""
    quad = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    cell_parts = [
        f"""select {', '.join(LINE_IDS)}, '{label}' as period, {turn} as turn, h
            from {ranked("cells", [f"bucket_{c}" for c in pair], LINE_IDS)} where rn <= {pct_take(0.02)}"""
        for turn, (label, pair) in enumerate((("one", quad[:2]), ("two", quad[2:])))
    ]
    positions = "(select o_orderkey, o_orderstatus, o_totalprice, row_number() over (order by o_orderkey) as pos from orders)"

    def position_limit(k: int) -> str:
        return rounded(f"1 + ((select count(*) from orders) - 1) * cast({k / 10} as double)", 2)

    position_bucket = "case " + " ".join(
        f"when pos < {position_limit(k + 1)} then cast({k / 10} as double)" for k in range(1, 9)
    ) + " else cast(0.9 as double) end"
    placed = f"(select o_orderkey, o_orderstatus, o_totalprice, {position_bucket} as position_bucket from {positions} as p)"
    order_sample = f"({sample('orders', ORDER, ['o_orderkey'], pct_take(0.1), ['o_orderkey', 'o_totalprice'])})"

    def measures(source: str, value: str) -> str:
        rows = [("min", "min(o_totalprice)"), ("mean", "avg(o_totalprice)"), ("max", "max(o_totalprice)")]
        rows += [(n, f"quantile_cont(o_totalprice, {p})") for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
        rows += [(f"decile_{k}", rounded(f"quantile_cont(o_totalprice, {k / 10})", 2)) for k in range(1, 11)]
        return " union all ".join(
            f"select '{n}' as measure, {rounded(e, 2)} as {value} from {source} as s" for n, e in rows
        )

    placed_docs = "(select *, 'documents.parquet' as file, row_number() over () - 1 as place from documents)"
    weekly = "(select event_id, event_type, user_id, cast(week(ts) as integer) as week from events)"
    share_4 = "(round_even(cast(500 as double) / (select count(*) from orders) * 10000, 0) / 10000)"
    statements = {
        "floor_sample": sample("documents", DOC, ["doc_id"], pct_take(0.1, 1), doc_cols),
        "floor_sample_of_three": sample("documents", DOC, ["doc_id"], pct_take(0.1, 3), doc_cols, seed=7),
        "floor_sample_many_strata": sample("part", PART, ["p_partkey"], pct_take(0.1, 1), ["p_partkey", *PART]),
        "floor_sample_few_strata": sample("lineitem", LINE, LINE_IDS, pct_take(0.1, 1), line_cols),
        "floor_sample_by_cut": sample("lineitem", LINE, LINE_IDS, pct_take(0.1, 1), line_cols),
        "floor_sample_mixed_sizes": sample("documents", DOC, ["doc_id"], pct_take(0.1, 1), doc_cols),
        "proportional_sample": sample("orders", ORDER, ["o_orderkey"], pct_take(0.1), ["o_orderkey", *ORDER]),
        "proportional_sample_vanishing": sample("documents", DOC, ["doc_id"], pct_take(0.1), doc_cols),
        "fixed_n_sample": sample("customer", CUSTOMER, ["c_custkey"], "3", ["c_custkey", *CUSTOMER]),
        "fixed_n_takes_small_strata_whole": sample("part", PART, ["p_partkey"], "3", ["p_partkey", *PART]),
        "fixed_n_large": sample("orders", ORDER, ["o_orderkey"], "250", ["o_orderkey", *ORDER]),
        "null_strata_sample": sample(ORDERS_NULLS, nulls, ["o_orderkey"], pct_take(0.1, 1), ["o_orderkey", *nulls]),
        "sample_without_ids": sample(
            "(select quality, toxic, row_number() over (partition by quality, toxic) as copy from labels)",
            ["quality"], ["quality", "toxic", "copy"], pct_take(0.2, 1), ["quality", "toxic"],
        ),
        "sample_of_copies": sample(
            "(select event_type, user_id, row_number() over (partition by event_type, user_id) as copy from events)",
            ["event_type"], ["event_type", "user_id", "copy"], pct_take(0.1, 1), ["event_type", "user_id"],
        ),
        "drop_small_strata": f"select doc_id, lang, source from {ranked('documents', DOC, ['doc_id'])} where pop_n >= 10",
        "sample_without_small_strata": sample("documents", DOC, ["doc_id"], f"{pct_take(0.1, 1)} and pop_n >= 10", doc_cols),
        "boost_small_strata": f"select * from {boosted('pop_n < 20')} as b",
        "boost_levels": f"""select * from {boosted("lang in ('es')")} as b""",
        "design_weight_total": "select lang, cast((select count(*) from {0} b where b.lang = d.lang) as bigint) as n, count(*) as stands_for from documents d group by lang".format(boosted("pop_n < 20")),
        "total_size_sample": total_sample("orders", ORDER, ["o_orderkey"], 500, ["o_orderkey", *ORDER]),
        "total_size_many_strata": total_sample("part", PART, ["p_partkey"], 100, ["p_partkey", *PART]),
        "total_size_rounded_share": sample("orders", ORDER, ["o_orderkey"], f"round_even(pop_n * {share_4}, 0)", ["o_orderkey", *ORDER]),
        "weighted_sample": sample("orders", ["o_orderpriority"], ["o_orderkey"], pct_take(0.1), ["o_orderkey", "o_orderpriority"], key=weight_key),
        "weighted_fixed_n": sample(
            "lineitem", LINE, LINE_IDS, "100", [*LINE_IDS, *LINE], key=weight_key.replace("o_totalprice", "l_quantity")
        ),
        "native_sample": f"""select o_orderkey, o_orderstatus from orders
            where {md5_of(42, ["o_orderkey"])} < {position("0.1")}""",
        "native_sample_null_levels": f"""select o_orderkey, priority from {ORDERS_NULLS} as o
            where {md5_of(42, ["o_orderkey"])} < case when priority is null then {position("0.5")}
                when priority = '1-URGENT' then {position("0.25")} else {position("0.05")} end""",
        "drift_after_merge": report(MERGED_DOCS, MERGED_SAMPLE, DOC, 3, THREE),
        "merge_levels_many": """select p_type, n, cast(n as double) / (select count(*) from part) as pct, n < 14 as is_rare,
            case when n < 14 then 'Other' else p_type end as label_new
            from (select p_type, count(*) as n from part group by p_type) as c""",
        "deciles_with_nan": " union all ".join(
            f"""select 'value' as "column", cast({k / 10} as double) as probability,
            {rounded(f'quantile_cont(value, {k / 10})', 2)} as value from events where event_type <> 'error'"""
            for k in range(1, 11)
        ),
        "summary_with_nan": f"""select 'value' as "column", count(value) as n, {rounded('min(value)', 3)} as min,
            {rounded('quantile_cont(value, 0.25)', 3)} as q1, {rounded('quantile_cont(value, 0.5)', 3)} as median,
            {rounded('avg(value)', 3)} as mean, {rounded('quantile_cont(value, 0.75)', 3)} as q3,
            {rounded('max(value)', 3)} as max from events where event_type <> 'error'""",
        "null_counts_with_nan": """select 'event_id' as "column", 0::bigint as n_null
            union all select 'value', count(*) from events where event_type = 'error'""",
        "position_buckets_large_keys": f"""select o_orderkey + {2**60}::bigint as key, position_bucket from {placed} as p""",
        "random_order_sample": sample(placed_docs, DOC, ["file", "place"], pct_take(0.1, 1), doc_cols),
        "total_size_with_floor": taken_sample("customer", CUSTOMER, ["c_custkey"], bounded_take("customer", CUSTOMER, 400, "least(3, pop_n)", "pop_n"), ["c_custkey", *CUSTOMER]),
        "total_size_with_boosts": taken_sample("documents", DOC, ["doc_id"], bounded_take(
            "documents", DOC, "(select count(*) // 2 from documents)", "case when pop_n < 3 then 0 when lang = 'es' then least(60, pop_n) else 1 end",
            "case when pop_n < 3 then 0 else least(60, pop_n) end"), doc_cols),
        "small_strata_collapsed": collapsed("part", "p_partkey", PART, 4),
        "small_strata_collapsed_by_shuffle": collapsed("documents", "doc_id", DOC, 9),
        "conditional_nulls": """select 'finished_priority' as "column", coalesce(p, '__NA__') as level, count(*) as n,
            cast(count(*) as double) / (select count(*) from orders) as share
            from (select case when o_orderstatus = 'F' then o_orderpriority end as p from orders) as o group by p""",
        "strata_sizes": f"""select o_orderstatus, priority, o_orderstatus || ' | ' || coalesce(priority, '__NA__') as stratum,
            count(*) as pop_n from {ORDERS_NULLS} as o group by o_orderstatus, priority""",
        "strata_count": "select count(*) as n_strata from (select distinct p_brand, p_type, p_size from part) as s",
        "strata_profile": f"""select count(*) as n_strata, count(*) filter (pop_n = 1) as n_size_1,
            count(*) filter (pop_n = 2) as n_size_2, count(*) filter (pop_n < 5) as n_under_5,
            count(*) filter (pop_n < 10) as n_under_10 from {doc_sizes} as s""",
        "allocation_table": f"""select lang, source, pop_n, {raw} as n_raw, greatest({raw}, 2) as n_target,
            least(greatest({raw}, 2), pop_n) as n_take, {raw} < 2 as is_floored, greatest({raw}, 2) > pop_n as is_capped
            from {doc_sizes} as s""",
        "floor_report": f"""select count(*) as n_strata, count(*) filter ({raw} < 1) as n_floored,
            count(*) filter (greatest({raw}, 1) > pop_n) as n_capped, count(*) filter ({raw} = 0) as n_vanishing,
            cast(sum(least(greatest({raw}, 1), pop_n)) as bigint) as n_take from {doc_sizes} as s""",
        "cap_report": f"""select count(*) as n_strata, cast(0 as bigint) as n_floored, count(*) filter (pop_n < 3) as n_capped,
            cast(0 as bigint) as n_vanishing, cast(sum(least(3, pop_n)) as bigint) as n_take from {part_sizes} as s""",
        "vanished_strata": f"select lang, source, pop_n from {doc_sizes} as s where {raw} = 0",
        "level_shares": f"""select "column", level, count(*) as n,
            cast(count(*) as double) / sum(count(*)) over (partition by "column") as share
            from ({long_levels(ORDERS_NULLS, nulls, "1 as one")}) as u group by "column", level""",
        "sample_rate": f"""select p.n as pop_n, s.n as samp_n, {rounded("cast(s.n as double) / p.n * 100", 2)} as samp_pct
            from (select count(*) as n from documents) p, (select count(*) as n from {DOC_SAMPLE} as x) s""",
        "drift_raw": f"""select "column", level, pop_pct, samp_pct, abs(pop_pct - samp_pct) as abs_diff
            from {compared("documents", DOC_SAMPLE, DOC)}""",
        "drift_two_tier": report("documents", DOC_SAMPLE, DOC, 2, TWO),
        "drift_three_tier": report("documents", DOC_SAMPLE, DOC, 3, THREE),
        "drift_lost_levels": report("documents", "(select * from documents where lang = 'en')", DOC, 3, THREE),
        "drift_flagged": """select "column", level, cast(pn as bigint) as pop_n, cast(sn as bigint) as samp_n, pop_pct, samp_pct,
            abs(pop_pct - samp_pct) as abs_diff from """
        + compared("events", "(select * from events where value > 50)", ["event_type"]),
        "drift_summary": summary(report("documents", DOC_SAMPLE, DOC, 2, TWO), 5),
        "drift_summary_with_floors": f"""select s.*, f.* from ({summary(report("documents", DOC_SAMPLE, DOC, 2, TWO), 5)}) as s,
            (select count(*) filter ({raw} < 2) as n_floored, count(*) filter (greatest({raw}, 2) > pop_n) as n_capped
             from {doc_sizes} as d) as f""",
        "drift_summary_strict": summary(
            report("documents", "(select * from documents where lang = 'en')", DOC, 3, THREE), 2
        ),
        "level_representation": f"""select level, pop_n, samp_n,
            {rounded("case when pop_n > 0 then cast(samp_n as double) / pop_n * 100 else 0 end", 2)} as kept_pct from (
            select v.level, (select count(*) from documents d where d.lang = v.level) as pop_n,
                   (select count(*) from {DOC_SAMPLE} as s where s.lang = v.level) as samp_n
            from (values ('es'), ('fr'), ('xx')) as v(level)) as t""",
        "merge_rare_share": f"select doc_id, lang, lang_original from {MERGED_DOCS} as m",
        "merge_rare_count": merged_by_count("customer", "c_custkey", "c_nationkey", 60),
        "merge_rare_count_many_levels": merged_by_count("part", "p_partkey", "p_type", 12),
        "merge_nulls": f"""select o.o_orderkey, o.priority as priority_original,
            case when c.n < 0.2 * (select count(*) from orders) then 'Other' else o.priority end as priority
            from {ORDERS_NULLS} o join (select priority, count(*) as n from {ORDERS_NULLS} as x group by priority) c
            on o.priority is not distinct from c.priority""",
        "merge_level_table": f"""select lang, n, pct, pct < 0.14 as is_rare,
            case when pct < 0.14 then 'Other' else lang end as label_new from {LANG_LEVELS} as l""",
        "merge_report": f"""select cast(round_even(0.14::double * sum(n), 0) as bigint) as limit_rows,
            count(*) filter (pct < 0.14) as n_merged, count(*) filter (pct >= 0.14) as n_kept,
            cast(coalesce(sum(n) filter (pct < 0.14), 0) as bigint) as rows_merged,
            cast(coalesce(sum(n) filter (pct >= 0.14), 0) as bigint) as rows_kept
            from {LANG_LEVELS} as l""",
        "strata_before_after": f"""select b as n_before, a as n_after, b - a as n_fewer from
            (select count(*) as b from (select distinct lang, source from documents) as x) as x1,
            (select count(*) as a from (select distinct lang, source from {MERGED_DOCS} as m) as y) as y1""",
        "sample_after_merge": f"select * from {MERGED_SAMPLE} as s",
        "merge_audit": f"select lang_original, count(*) as n_in_sample from {MERGED_SAMPLE} as s where lang = 'Other' group by lang_original",
        "coerced_numbers": "select event_id, case when event_type = 'error' then 0 else cast(user_id as double) end as amount from events",
        "winsorized": f"select event_id, {rounded('least(value, (select quantile_cont(value, 0.99) from events))', 4)} as value from events",
        "tail_quantiles": long_numbers(
            ["l_quantity", "l_extendedprice", "l_discount"], "lineitem",
            """select '{c}' as "column", cast(0.99 as double) as probability,
            floor(quantile_cont({c}, 0.99) * 10000 + 0.5) / 10000 as value from {t}""",
        ),
        "deciles": " union all ".join(
            f"""select '{c}' as "column", cast({k / 10} as double) as probability,
            {rounded(f'quantile_cont({c}, {k / 10})', 2)} as value from lineitem"""
            for c in ("l_quantity", "l_extendedprice") for k in range(1, 11)
        ),
        "deciles_winsorized": " union all ".join(
            f"""select 'value' as "column", cast({k / 10} as double) as probability,
            {rounded(f'quantile_cont(value, {k / 10})', 2)} as value from {clipped(["value"], ["event_id"], "events")} as w"""
            for k in range(1, 11)
        ),
        "decile_buckets": f"select c_custkey, c_acctbal, {bucket('c_acctbal', 'c_acctbal', 'customer')} as bucket_c_acctbal from customer",
        "decile_cells": f"with cells as materialized {cells(quad[:2])} "
        + sample("cells", ["bucket_l_quantity", "bucket_l_extendedprice"], LINE_IDS, pct_take(0.05),
                 [*LINE_IDS, "bucket_l_quantity", "bucket_l_extendedprice"]),
        "bucket_columns": f"""select {bucket('l_quantity', 'l_quantity', 'lineitem')} as bucket_l_quantity,
            {bucket('l_tax', 'l_tax', 'lineitem')} as bucket_l_tax, count(*) as n from lineitem group by 1, 2""",
        "position_buckets": f"select o_orderkey, position_bucket from {placed} as p",
        "position_sample": f"""select o_orderkey, o_orderstatus,
            {rounded('least(o_totalprice, (select quantile_cont(o_totalprice, 0.99) from orders))', 2)} as o_totalprice
            from {ranked(placed, ["position_bucket"], ["o_orderkey"])} where rn <= round_even(pop_n * {share_4}, 0)""",
        "row_positions": "select o_orderkey, o_totalprice, row_number() over (order by o_totalprice, o_orderkey) as row_position from orders",
        "numeric_summary": " union all ".join(
            f"""select '{c}' as "column", count({c}) as n, {rounded(f'min({c})', 3)} as min,
            {rounded(f'quantile_cont({c}, 0.25)', 3)} as q1, {rounded(f'quantile_cont({c}, 0.5)', 3)} as median,
            {rounded(f'avg({c})', 3)} as mean, {rounded(f'quantile_cont({c}, 0.75)', 3)} as q3,
            {rounded(f'max({c})', 3)} as max from lineitem"""
            for c in ("l_quantity", "l_extendedprice")
        ),
        "numeric_before_after": f"""select 'o_totalprice' as "column", p.measure, population, sample from
            ({measures("orders", "population")}) as p join ({measures(order_sample, "sample")}) as s on p.measure = s.measure""",
        "null_counts": long_numbers(
            ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "priority"],
            ORDERS_NULLS, """select '{c}' as "column", count(*) filter ({c} is null) as n_null from {t} as o""",
        ),
        "numeric_column_totals": long_numbers(
            ["o_orderkey", "o_custkey", "o_totalprice"], "orders",
            """select '{c}' as "column", count(*) filter ({c} is null) as n_null from {t}""",
        ),
        "two_period_sample": f"select * from {two_periods} as p",
        "two_period_id_list": f"select user_id from {two_periods} as p",
        "two_period_cells": f"""with cells as materialized {cells(quad)}
            select {', '.join(LINE_IDS)}, period from (select *,
            row_number() over (partition by l_orderkey order by turn, h, {', '.join(LINE_IDS)}) as first_row
            from ({" union all ".join(cell_parts)}) as u) as f where first_row = 1""",
        "chunk_sample": sample(events, ["chunk_id", "event_type"], ["event_id"], pct_take(0.01, 3), ["event_id", "event_type", "chunk_id"]),
        "chunk_sample_global_floor": sample(events, ["event_type"], ["event_id"], pct_take(0.01, 3), ["event_id", "event_type", "chunk_id"]),
        "chunk_sample_by_position": sample(
            "(select o_orderkey, o_orderpriority, (row_number() over (order by o_orderkey) - 1) // 2000 as chunk_id from orders)",
            ["chunk_id", "o_orderpriority"], ["o_orderkey"], pct_take(0.05, 1), ["o_orderkey", "o_orderpriority", "chunk_id"],
        ),
        "chunk_sample_by_file": sample(
            "(select o_orderkey, o_orderpriority, 'orders.parquet#' || (row_number() over () - 1) // 2000 as chunk_id from orders)",
            ["chunk_id", "o_orderpriority"], ["o_orderkey"], pct_take(0.05, 1), ["o_orderkey", "o_orderpriority", "chunk_id"],
        ),
        "stream_sample": sample(weekly, ["week", "event_type"], ["event_id"], pct_take(0.1, 1), ["event_id", "event_type", "week"]),
        "stream_sample_global_floor": f"""select event_id, event_type, user_id, week
            from {ranked(weekly, ["user_id"], ["event_id"])} where rn <= 2 or h < {position("0.01")}""",
        "csv_round_trip": sample("customer", ["c_mktsegment"], ["c_custkey"], pct_take(0.1, 1), ["c_custkey", "c_mktsegment", "c_acctbal"]),
        "parquet_round_trip": f"select * from {DOC_SAMPLE} as s",
        "catalog_sample": sample("customer", ["c_mktsegment"], ["c_custkey"], pct_take(0.1, 1), ["c_custkey", "c_mktsegment"]),
        "catalog_table_sample": sample("customer", ["c_mktsegment"], ["c_custkey"], pct_take(0.1, 1), ["c_custkey", "c_mktsegment"]),
        "preview": "select o_orderkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 5",
    }
    statements["weighted_sample_by_cut"] = statements["weighted_sample"]
    statements["drift_weighted"] = f"""select "column", level, pop_pct, samp_pct, d as abs_diff_pct, {THREE} as status
        from (select "column", level, pop_pct, {rounded("samp_pct", 9)} as samp_pct,
              {rounded("abs(pop_pct - samp_pct) * 100", 3)} as d
              from {compared("documents", boosted("pop_n < 20"), DOC, "design_weight")}) as t"""
    return statements
