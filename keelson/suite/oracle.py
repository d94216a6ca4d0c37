"""The registered queries as SQL over the same tables, for DuckDB.

Written from the meaning of each query, not from its plan: a chain of common table expressions
for the states of the tables after each run, and one final SELECT per query.
"""

from __future__ import annotations

from keelson.spec import CONTENT_COLUMNS, CUSTOMER_COLUMNS, REGIONS
from keelson.suite import feed
from keelson.suite.feed import RUNS

AUDIT = (
    "_pipeline_run_id",
    "_batch_id",
    "_source_system",
    "_load_type",
    "_created_at",
    "_ingestion_date",
    "_source_file_path",
    "_source_file_name",
)
BRONZE = (*CUSTOMER_COLUMNS, *AUDIT)
SILVER = (*BRONZE, "customer_region", "_record_hash", "_silver_update_ts")
ATTRIBUTES = (
    "SurrogateKey",
    "BusinessKey_CustomerID",
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "customer_region",
    "_record_hash",
)


def _list(columns, prefix="") -> str:
    return ", ".join(f"{prefix}{c}" for c in columns)


def _as_of(n: int) -> str:
    return f"timestamp '{RUNS[n - 1].as_of:%Y-%m-%d %H:%M:%S}'"


def _region(state: str) -> str:
    cases = " ".join(
        f"when {state} in ({', '.join(repr(c) for c in codes)}) then '{name}'"
        for name, codes in REGIONS.items()
    )
    return f"case {cases} else 'Unknown' end"


# The feed as it would be after ingesting CSV drops: load time is the time of the run.
_INGESTED = f"""
    select {_list(CUSTOMER_COLUMNS)}, _pipeline_run_id, _batch_id, _source_system, _load_type,
           case _batch_id when '{RUNS[0].batch_id}' then {_as_of(1)}
                          when '{RUNS[1].batch_id}' then {_as_of(2)} else {_as_of(3)} end
             as _created_at,
           _ingestion_date, _source_file_path, concat('drop=', _source_file_name) as _source_file_name
    from feed"""

_PREPARED = f"""
    select *, {_region('customer_state')} as customer_region,
           md5(concat_ws('||', customer_zip_code_prefix, customer_city, customer_state)) as _record_hash,
           concat_ws(',', case when customer_id is null then 'DQ-01' end,
                          case when customer_unique_id is null then 'DQ-02' end,
                          case when coalesce(length(customer_state) <> 2, true) then 'DQ-03' end,
                          case when coalesce(not regexp_full_match(customer_zip_code_prefix, '[0-9]+'), true)
                               then 'DQ-04' end) as reason
    from (select customer_id, customer_unique_id,
                 trim(customer_zip_code_prefix) as customer_zip_code_prefix,
                 upper(trim(customer_city)) as customer_city,
                 upper(trim(customer_state)) as customer_state, {_list(AUDIT)},
                 customer_zip_code_prefix as raw_zip, customer_city as raw_city,
                 customer_state as raw_state
          from bronze)"""


def _source(n: int, batches: str = "<=", extra=()) -> str:
    return f"""
    select {_list(BRONZE)}, customer_region, _record_hash, {_as_of(n)} as _silver_update_ts
           {"".join(", " + c for c in extra)}
    from prepared where reason = '' and _batch_id {batches} '{RUNS[n - 1].batch_id}'
    qualify row_number() over (partition by customer_id order by _created_at desc nulls last,
        _source_file_name desc nulls last, customer_unique_id desc nulls last,
        customer_zip_code_prefix desc nulls last, customer_city desc nulls last,
        customer_state desc nulls last) = 1"""


def _upserted(target: str, source: str, update=None, extra=()) -> str:
    update = set(update or (*SILVER, *extra))
    columns = (*SILVER, *extra)
    kept = [c for c in columns if c not in update]
    return f"""
    select {_list(columns)} from {source} s where not exists
        (select 1 from {target} t where t.customer_id = s.customer_id)
    union all
    select {_list(columns)} from {target} t where not exists
        (select 1 from {source} s where t.customer_id = s.customer_id and t._record_hash <> s._record_hash)
    union all
    select {', '.join(('t.' if c in kept else 's.') + c for c in columns)}
    from {target} t join {source} s on t.customer_id = s.customer_id
    where t._record_hash <> s._record_hash"""


def _dim(source: str, extra=()) -> str:
    return f"""
    select sha256(customer_id) as SurrogateKey, customer_id as BusinessKey_CustomerID,
           {_list((*ATTRIBUTES[2:], *extra))} from {source}"""


def _opened(version: str, n: int) -> str:
    return (
        f"cast({version} as integer) as Version, true as IsCurrent,"
        f" {_as_of(n)} as EffectiveStartDate, cast(null as timestamp) as EffectiveEndDate,"
        f" '{RUNS[n - 1].batch_id}' as _audit_insert_batch,"
        f" cast(null as varchar) as _audit_update_batch"
    )


_VERSIONING = (
    "Version",
    "IsCurrent",
    "EffectiveStartDate",
    "EffectiveEndDate",
    "_audit_insert_batch",
    "_audit_update_batch",
)
GOLD = (*ATTRIBUTES, *_VERSIONING)


def _applied(target: str, dim: str, n: int, extra=(), full=False) -> str:
    """``full``: keys the load lacks are closed, and closed keys go on from their last version."""
    attributes = (*ATTRIBUTES, *extra)
    columns = (*attributes, *_VERSIONING)
    known = f"{target} g join {dim} d on g.IsCurrent and g.BusinessKey_CustomerID = d.BusinessKey_CustomerID"
    changed = f"{known} and g._record_hash <> d._record_hash"
    closed = f"{_list(attributes, 'g.')}, g.Version, false, g.EffectiveStartDate, {_as_of(n)}, g._audit_insert_batch, '{RUNS[n - 1].batch_id}'"
    last = f"(select max(p.Version) from {target} p where p.BusinessKey_CustomerID = d.BusinessKey_CustomerID)"
    absent = f"""
    union all
    select {closed} from {target} g where g.IsCurrent and not exists
        (select 1 from {dim} d where g.BusinessKey_CustomerID = d.BusinessKey_CustomerID)"""
    stays = f"""not (g.IsCurrent and exists
        (select 1 from {dim} d where g.BusinessKey_CustomerID = d.BusinessKey_CustomerID
                                 and g._record_hash <> d._record_hash))"""
    if full:
        stays += f""" and (not g.IsCurrent or exists
        (select 1 from {dim} d where g.BusinessKey_CustomerID = d.BusinessKey_CustomerID))"""
    return f"""
    select {_list(columns)} from {target} g where {stays}
    union all
    select {closed} from {changed}{absent if full else ""}
    union all
    select {_list(attributes, 'd.')}, {_opened('g.Version + 1', n)} from {changed}
    union all
    select {_list(attributes, 'd.')}, {_opened(f"coalesce({last}, 0) + 1" if full else "1", n)} from {dim} d where not exists
        (select 1 from {target} g where g.BusinessKey_CustomerID = d.BusinessKey_CustomerID{" and g.IsCurrent" if full else ""})"""


def _chain(ingested: bool = False, update=None) -> dict[str, str]:
    steps = {
        "feed": feed.FEED_SQL,
        "bronze": _INGESTED if ingested else "select * from feed",
        "prepared": _PREPARED,
    }
    for n in (1, 2, 3):
        steps[f"source{n}"] = _source(n)
        steps[f"silver{n}"] = (
            f"select {_list(SILVER)} from source1"
            if n == 1
            else _upserted(f"silver{n - 1}", f"source{n}", update)
        )
        steps[f"dim{n}"] = _dim(f"silver{n}")
        steps[f"gold{n}"] = (
            f"select *, {_opened('1', 1)} from dim1"
            if n == 1
            else _applied(f"gold{n - 1}", f"dim{n}", n)
        )
    return steps


def _sql(last: str, final: str, **options) -> str:
    """The chain up to step ``last``, then ``final``."""
    steps = _chain(**options)
    used = list(steps)[: list(steps).index(last) + 1]
    return f"with {', '.join(f'{name} as ({steps[name]})' for name in used)} {final}"


def _with(steps: dict[str, str], final: str) -> str:
    return f"with {', '.join(f'{name} as ({step})' for name, step in steps.items())} {final}"


def _full_loads() -> str:
    """Each batch alone, as a load that holds every key."""
    steps = {"feed": feed.FEED_SQL, "bronze": "select * from feed", "prepared": _PREPARED}
    for n in (1, 2, 3):
        steps[f"source{n}"] = _source(n, "=")
        steps[f"dim{n}"] = _dim(f"source{n}")
        steps[f"gold{n}"] = (
            f"select *, {_opened('1', 1)} from dim1" if n == 1 else _applied(f"gold{n - 1}", f"dim{n}", n, full=True)
        )
    return _with(steps, "select * from gold3")


_EXTRA = ("account", "priority")
_WIDENING = {
    "feed": f"""
    select {', '.join(feed.selected(feed.MASTER_COLUMNS))}, cast({feed.MASTER_ACCOUNT} as bigint) as account,
           cast(null as varchar) as priority from customer
    union all select * from (
        select {', '.join(feed.selected(feed.ORDER_COLUMNS))}, {feed.ORDER_ACCOUNT}, o_orderpriority from orders)
    where _batch_id = '{RUNS[1].batch_id}'""",
    "bronze": "select * from feed",
    "prepared": _PREPARED.replace("customer_state as raw_state", "customer_state as raw_state, account, priority"),
}


def _changes(before: str, after: str) -> str:
    """Rows of the one that the other lacks, named by what became of their key."""

    def side(rows: str, others: str, alone: str, paired: str) -> str:
        return f"""
        select case when exists (select 1 from {others} o where o.customer_id is not distinct from d.customer_id)
                    then '{paired}' else '{alone}' end as _change, d.*
        from (select {_list(SILVER)} from {rows} except select {_list(SILVER)} from {others}) d"""

    return f"{side(before, after, 'delete', 'update_before')} union all {side(after, before, 'insert', 'update_after')}"


def _widened() -> str:
    steps = dict(_WIDENING)
    for n in (1, 2):
        steps[f"source{n}"] = _source(n, "=", _EXTRA)
        steps[f"silver{n}"] = f"select * from source{n}" if n == 1 else _upserted("silver1", "source2", extra=_EXTRA)
        steps[f"dim{n}"] = _dim(f"silver{n}", _EXTRA)
        steps[f"gold{n}"] = f"select *, {_opened('1', 1)} from dim1" if n == 1 else _applied("gold1", "dim2", 2, _EXTRA)
    return _with(steps, "select * from gold2")


def _histories() -> str:
    """The islands of equal records along each customer's deliveries, after the first and after both loads."""
    steps = {"feed": feed.FEED_SQL, "bronze": "select * from feed", "prepared": _PREPARED}
    early = f"_batch_id = '{feed.FIRST_ORDERS_BATCH}'"
    steps["rows"] = f"""
    select sha256(customer_id) as SurrogateKey, customer_id as BusinessKey_CustomerID, {_list(ATTRIBUTES[2:])},
           _created_at, case when {early} then 2 else 1 end as load from prepared where reason = ''"""
    for n in (1, 2):
        steps[f"seen{n}"] = f"""
        select * from rows where load <= {n} and _created_at is not null
        qualify row_number() over (partition by BusinessKey_CustomerID, _created_at
            order by load desc, _record_hash desc, customer_unique_id desc) = 1"""
        steps[f"island{n}"] = f"""
        select * from seen{n} qualify coalesce(_record_hash <> lag(_record_hash) over
            (partition by BusinessKey_CustomerID order by _created_at), true)"""
        steps[f"history{n}"] = f"""
        select {_list(ATTRIBUTES)}, cast(row_number() over w as integer) as Version,
               lead(_created_at) over w is null as IsCurrent, _created_at as EffectiveStartDate,
               lead(_created_at) over w as EffectiveEndDate
        from island{n} window w as (partition by BusinessKey_CustomerID order by _created_at)"""
    return _with(
        steps,
        f"""select h.*, case when o.Version is null then '{RUNS[1].batch_id}' else '{RUNS[0].batch_id}' end as _audit_insert_batch,
                   case when o.Version is not null and (o.Version <> h.Version or o.EffectiveEndDate is distinct from h.EffectiveEndDate)
                        then '{RUNS[1].batch_id}' end as _audit_update_batch
            from history2 h left join history1 o on o.BusinessKey_CustomerID = h.BusinessKey_CustomerID
             and o.EffectiveStartDate = h.EffectiveStartDate and o._record_hash = h._record_hash""",
    )


_QUARANTINE = f"""select customer_id, customer_unique_id, raw_zip as customer_zip_code_prefix,
    raw_city as customer_city, raw_state as customer_state, {{audit}}, reason as _dq_error_reason,
    {_as_of(3)} as _quarantine_ts, 'run-3' as _quarantine_run_id from prepared where reason <> ''"""

_AUDIT_WITHOUT_PATH = _list(c for c in AUDIT if c != "_source_file_path")

_ORDERS = (
    f"(select o_orderkey, o_orderdate, o_totalprice, {feed.ORDER_CUSTOMER_KEY} as order_customer"
    " from orders)"
)


#: The same reports over the state of all files.
INCREMENTAL = {
    "dq_incremental_load_profile": "dq_load_profile",
    "dq_incremental_null_profile": "dq_null_profile",
    "dq_incremental_duplicate_keys": "dq_duplicate_keys",
    "dq_incremental_top_states": "dq_top_states",
    "dq_incremental_bad_format": "dq_bad_format_raw",
    "dq_incremental_lineage": "dq_lineage",
}


def all_oracles() -> dict[str, str]:
    found = _oracles()
    return found | {name: found[same] for name, same in INCREMENTAL.items()}


def _oracles() -> dict[str, str]:
    count = "cast(count(*) as bigint)"
    return {
        "standardize": _sql(
            "prepared", f"select {_list(CUSTOMER_COLUMNS)}, _source_file_name from prepared"
        ),
        "region_map": _sql(
            "prepared", "select customer_id, customer_state, customer_region from prepared"
        ),
        "record_hash": _sql(
            "prepared",
            """select customer_id, _record_hash, md5(cast(to_json([customer_zip_code_prefix,
               customer_city, customer_state]) as varchar)) as null_safe_hash from prepared""",
        ),
        "surrogate_key": _sql("source3", _dim("source3")),
        "dq_valid": _sql(
            "prepared",
            f"""select {_list(BRONZE)}, customer_region, _record_hash,
                {_as_of(3)} as _silver_update_ts from prepared where reason = ''""",
        ),
        "dq_quarantine": _sql("prepared", _QUARANTINE.format(audit=_list(AUDIT))),
        "dq_quarantine_by_rule": _sql(
            "prepared",
            f"""select reason as _dq_error_reason, {count} as rows
                from prepared where reason <> '' group by reason""",
        ),
        "dedup_latest": """select * from events
            qualify row_number() over (partition by user_id
                order by ts desc nulls last, event_id desc) = 1""",
        "dedup_feed": _sql("source3", "select * from source3"),
        "delete_by_file": _sql(
            "bronze", "select * from bronze where _source_file_name <> 'orders_1997a.csv'"
        ),
        "replace_by_file": _sql(
            "bronze",
            f"""select * from bronze where _batch_id <> '{feed.LAST_ORDERS_BATCH}' union all
                select customer_id, customer_unique_id, customer_zip_code_prefix,
                       coalesce(customer_city, 'unknown'), customer_state, 'run-4', {_list(AUDIT[1:])}
                from bronze where _batch_id = '{feed.LAST_ORDERS_BATCH}'""",
        ),
        "schema_evolve_union": """
            select c_custkey as customer_number, c_name as customer_name, c_mktsegment as segment,
                   cast(null as varchar) as priority from customer
            union all select o_custkey, null, null, o_orderpriority from orders""",
        "clustered_rewrite": _sql("source3", "select * from source3"),
        "upsert_initial": _sql("source3", f"select {_list(SILVER)} from source3"),
        "upsert_changed": _sql("silver3", "select * from silver3", update=CONTENT_COLUMNS),
        "upsert_all_columns": _sql("silver3", "select * from silver3"),
        "upsert_new_keys": _sql(
            "source3",
            "select * from source3 where customer_id not in (select customer_id from source2)",
        ),
        "upsert_rerun": _sql("silver3", "select * from silver3"),
        "silver_build": _sql("silver3", "select * from silver3"),
        "scd2_initial": _sql(
            "source3", f"select *, {_opened('1', 1)} from ({_dim('source3')})"
        ),
        "next_version": _sql(
            "dim3",
            """select d.*, cast(coalesce(g.Version + 1, 1) as integer) as NewVersion
               from dim3 d left join gold2 g
               on g.IsCurrent and g.BusinessKey_CustomerID = d.BusinessKey_CustomerID""",
        ),
        "detect_changes": _sql(
            "dim3",
            """select d.* from dim3 d join gold2 g
               on g.IsCurrent and g.BusinessKey_CustomerID = d.BusinessKey_CustomerID
               where d._record_hash <> g._record_hash""",
        ),
        "scd2_apply": _sql("gold3", "select * from gold3"),
        "scd2_rerun": _sql("gold3", "select * from gold3"),
        "gold_build": _sql("gold3", "select * from gold3"),
        "scd2_current": _sql("gold3", "select * from gold3 where IsCurrent"),
        "scd2_history": _sql(
            "gold3",
            """select BusinessKey_CustomerID, customer_city, customer_state, Version, IsCurrent,
                      EffectiveStartDate, EffectiveEndDate from gold3 where not IsCurrent""",
        ),
        "scd2_counts": _sql(
            "gold3",
            f"""select {count} as total_records,
                {count} filter (IsCurrent) as active_records,
                {count} filter (not IsCurrent) as history_records from gold3""".replace(
                "cast(count(*) as bigint) filter", "count(*) filter"
            ),
        ),
        "version_counts": _sql(
            "gold3", f"select Version, IsCurrent, {count} as count from gold3 group by all"
        ),
        "fact_dim_join": _sql(
            "gold3",
            f"""select o.*, {_list(ATTRIBUTES[:-1], 'g.')},
                       g.BusinessKey_CustomerID is not null as in_dimension from {_ORDERS} o
                left join gold3 g on o.order_customer = g.BusinessKey_CustomerID and g.IsCurrent""",
        ),
        "fact_dim_totals": _sql(
            "gold3",
            f"""select customer_region, g.BusinessKey_CustomerID is not null as in_dimension,
                       {count} as orders,
                       cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as total
                from {_ORDERS} o
                left join gold3 g on o.order_customer = g.BusinessKey_CustomerID and g.IsCurrent
                group by all""",
        ),
        "fact_dim_as_of": _sql(
            "gold3",
            f"""select o.*, {_list((*ATTRIBUTES[:-1], 'Version'), 'g.')},
                       g.BusinessKey_CustomerID is not null as in_dimension from {_ORDERS} o
                left join gold3 g on o.order_customer = g.BusinessKey_CustomerID
                 and g.EffectiveStartDate <= o.o_orderdate
                 and (g.EffectiveEndDate is null or o.o_orderdate < g.EffectiveEndDate)""",
        ),
        "scd2_late_arrivals": _histories(),
        "scd2_closed_keys": _full_loads(),
        "merge_evolving": _widened(),
        "silver_changes": _sql("silver3", _changes("silver2", "silver3")),
        "load_changes": _with(
            {"feed": feed.FEED_SQL, "bronze": "select * from feed", "prepared": _PREPARED}
            | {f"source{n}": _source(n, "=") for n in (2, 3)},
            _changes("source2", "source3"),
        ),
        "quarantine_evolving": _with(
            _WIDENING,
            _QUARANTINE.format(audit=f"{_list(AUDIT)}, {_list(_EXTRA)}")
            .replace(_as_of(3), f"case _batch_id when '{RUNS[0].batch_id}' then {_as_of(1)} else {_as_of(2)} end")
            .replace("'run-3'", f"case _batch_id when '{RUNS[0].batch_id}' then 'run-1' else 'run-2' end"),
        ),
        "clustered_interleaved": _sql("source3", "select * from source3"),
        "silver_copartitioned": _sql("silver3", "select * from silver3"),
        "dq_load_profile": _sql(
            "bronze",
            f"""select {count} as total_rows, count(distinct _batch_id) as total_batches,
                       min(_ingestion_date) as first_ingestion,
                       max(_ingestion_date) as latest_ingestion from bronze""",
        ),
        "dq_null_profile": _sql(
            "bronze",
            """select count(*) filter (customer_id is null) as null_customer_id,
                count(*) filter (customer_unique_id is null) as null_unique_id,
                count(*) filter (customer_zip_code_prefix is null) as null_zip,
                count(*) filter (customer_city is null) as null_city,
                count(*) filter (customer_state is null) as null_state from bronze""",
        ),
        "dq_duplicate_keys": _sql(
            "bronze",
            f"""select _batch_id, customer_id, {count} as cnt from bronze group by all
                having count(*) > 1
                order by cnt desc, _batch_id, customer_id nulls last limit 20""",
        ),
        # Half-up rounding to two places in whole numbers.
        "dq_top_states": _sql(
            "bronze",
            f"""select customer_state, {count} as total_customers,
                    cast((20000 * count(*) + (select count(*) from bronze))
                         // (2 * (select count(*) from bronze)) as double) / 100 as pct
                from bronze group by customer_state
                order by total_customers desc, customer_state nulls last limit 10""",
        ),
        "dq_lineage": _sql(
            "bronze",
            f"""select _source_file_name, _batch_id, _load_type, _source_system,
                       {count} as rows_in_batch from bronze group by all""",
        ),
        "dq_bad_format": _sql(
            "prepared",
            f"""select customer_zip_code_prefix, {count} as cnt from prepared
                where not regexp_full_match(customer_zip_code_prefix, '[0-9]+')
                group by all order by cnt desc, customer_zip_code_prefix limit 20""",
        ),
        "dq_bad_format_raw": _sql(
            "bronze",
            f"""select customer_zip_code_prefix, {count} as cnt from bronze
                where not regexp_full_match(customer_zip_code_prefix, '[0-9]+')
                group by all order by cnt desc, customer_zip_code_prefix limit 20""",
        ),
        "newest_rows": _sql(
            "bronze",
            "select * from bronze order by "
            + ", ".join(
                f"{c} desc nulls last"
                for c in ("_created_at", *CUSTOMER_COLUMNS, "_source_file_name")
            )
            + " limit 10",
        ),
        "batch_file_counts": _sql(
            "bronze", f"select _batch_id, _source_file_name, {count} as count from bronze group by all"
        ),
        "region_state_counts": _sql(
            "source3",
            f"select customer_region, customer_state, {count} as count from source3 group by all",
        ),
        "run_row_count": _sql(
            "bronze",
            f"select {count} as inserted_rows from bronze where _pipeline_run_id = 'run-3'",
        ),
        "run_metrics": _sql(
            "prepared",
            f"""select {count} as total_read,
                count(distinct customer_id) filter (reason = '') as valid_records,
                count(*) filter (reason <> '') as quarantined_records,
                count(*) filter (reason = '') - count(distinct customer_id) filter (reason = '')
                    as duplicates_dropped
                from prepared""",
        ),
        "feed_contract": _sql(
            "bronze",
            """select distinct _source_file_name as drop, '' as missing_columns,
                      '' as extra_columns, true as is_valid, true as has_delimiter,
                      false as is_empty from bronze""",
        ),
        "feed_rescued_rows": f"""
            with lines as (select _source_file_name, {feed.DAMAGED_LINE} as line, {feed.IS_DAMAGED} as damaged
                from (select {', '.join(feed.selected(feed.ORDER_COLUMNS))}, o_orderkey as number from orders))
            select concat('drop=', _source_file_name) as _source_file_name, line as _rescued_row, 'DQ-00' as rule,
                   cast(1 as bigint) as lines from lines where damaged
            union all
            select concat('drop=', _source_file_name), null, null, {count} from lines where not damaged
            group by _source_file_name""",
        "ingest_bronze": _sql(
            "bronze",
            f"select {_list(CUSTOMER_COLUMNS)}, {_AUDIT_WITHOUT_PATH} from bronze",
            ingested=True,
        ),
        "ingest_with_ledger": _sql(
            "bronze",
            f"select {_list(CUSTOMER_COLUMNS)}, {_AUDIT_WITHOUT_PATH} from bronze",
            ingested=True,
        ),
        "ledger_entries": _sql(
            "bronze",
            f"""select _source_file_name as source, '{",".join(CUSTOMER_COLUMNS)}' as first_line,
                       {count} as rows, _batch_id as batch_id, _created_at as ingested_at
                from bronze group by all""",
            ingested=True,
        ),
        "medallion_end_to_end": _sql("gold3", "select * from gold3", ingested=True),
        "medallion_bucketed": _sql("gold3", "select * from gold3", ingested=True),
        "medallion_quarantine": _sql(
            "prepared", _QUARANTINE.format(audit=_AUDIT_WITHOUT_PATH), ingested=True
        ),
    }
