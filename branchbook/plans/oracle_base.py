"""Shared CTEs of the DuckDB oracle: the star schema mapped from the driver tables.

Each oracle query is ``WITH <the CTEs it needs> <body>``, run by DuckDB on the
raw parquet views; the Spark side reads the same mapping through the written
warehouse table.
"""

from __future__ import annotations

CTES: dict[str, str] = {}
DEPS: dict[str, tuple[str, ...]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = sql.strip()
    DEPS[name] = deps


cte("fact_operations", """
select n.n_nationkey as filial_id, l.l_partkey as inc_gk, cast(l.l_shipdate as date) as operation_date,
       concat(cast(year(l.l_shipdate) as varchar(4)), '_', cast(month(l.l_shipdate) as varchar(2))) as period,
       cast(year(l.l_shipdate)*12 + month(l.l_shipdate) as int) as period_idx,
       case when c.c_mktsegment = 'HOUSEHOLD' then 'B2C' else 'B2B' end as sender_category,
       cast(l.l_quantity*p.p_size/10 as decimal(10,3)) as weight,
       cast(l.l_quantity as int) as cnt,
       cast(cast(l.l_extendedprice as decimal(18,2)) * (1 - cast(l.l_discount as decimal(4,2))) as decimal(18,2)) as summa
from lineitem l
join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
join supplier s on l.l_suppkey = s.s_suppkey
join nation n on s.s_nationkey = n.n_nationkey
join part p on l.l_partkey = p.p_partkey
""")

cte("dim_filials", """
select n_nationkey as filial_id, n_name as filial_name, r_name as region
from nation join region on n_regionkey = r_regionkey
""")

cte("dim_products", """
select p_partkey as inc_gk, p_name as inc_name, p_type as product, p_brand as subcategory,
       case when p_size <= 25 then 'DOM' else 'INT' end as direction
from part
""")


def _order(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(body: str, *names: str) -> str:
    """``WITH`` the named shared CTEs (and their dependencies) in front of ``body``.

    If ``body`` starts with its own ``WITH``, its CTEs are appended after ours.
    """
    parts = [f"{n} AS (\n{CTES[n]}\n)" for n in _order(names)]
    b = body.strip()
    if b[:4].lower() == "with":
        return "WITH " + ",\n".join(parts) + ",\n" + b[4:].lstrip()
    return "WITH " + ",\n".join(parts) + "\n" + b
