"""SQL of the fixture views and of shared expressions, for the oracle side."""

from __future__ import annotations

from collections.abc import Sequence

from tidepanel.functions import scalar

PANEL = """
select l_suppkey as ticker, cast(l_shipdate as date) as date,
       arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)) as close,
       max(l_extendedprice) as high, min(l_extendedprice) as low,
       arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)) as open,
       sum(l_quantity) as volume
from lineitem group by 1, 2
"""

TICKER_MAP = """
select s_suppkey as ticker,
       case when s_suppkey % 17 = 3 then null
            when s_suppkey % 17 = 5 then cast(s_suppkey as varchar)
            when s_suppkey % 17 = 7 then s_suppkey || ' ZZ'
            when s_suppkey % 17 = 9 then s_suppkey || ' PFD ' || code
            else s_suppkey || ' ' || code end as bloomberg_ticker,
       s_suppkey || '.Y' as yahoo, s_suppkey as line
from (select *, case s_nationkey % 5 when 0 then 'US' when 1 then 'LN' when 2 then 'JP'
                                     when 3 then 'GY' else 'FP' end as code from supplier)
"""

SECTORS = """
select s_suppkey || '.Y' as ticker, r_name as sector, n_name as industry
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where r_name <> 'ASIA'
"""

TARGETS = """
select date, ticker, (sign(lead(close) over (partition by ticker order by date) - close) + 1) / 2
       as target
from panel
"""

MATRIX = """
select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                 strftime(l_shipdate, '%Y%m%d'), cast(round(l_extendedprice * 100) as bigint)) as id,
       strftime(l_shipdate, '%Y%m') as era,
       case when strftime(l_shipdate, '%Y%m') < '200001' then 'train'
            when strftime(l_shipdate, '%Y%m') < '200107' then 'validation' else 'test' end as data_type,
       cast(least(floor((l_quantity - 1) / 10), 4) as int) as feature_quantity,
       cast(least(floor(cast(round(l_discount * 100) as int) / 2), 4) as int) as feature_discount,
       cast(least(floor(cast(round(l_tax * 100) as int) / 2), 4) as int) as feature_tax_group,
       cast(least(floor(l_extendedprice / 20000), 4) as int) as feature_price_group,
       cast(least(l_linenumber - 1, 4) as int) as feature_line,
       case l_returnflag when 'A' then 0.0::double when 'R' then 1.0::double
                         when 'N' then 0.5::double end as target,
       case when l_linestatus = 'O' then l_tax * 10 end as target_late,
       l_discount * l_quantity as prediction, l_extendedprice as price
from lineitem
"""

VIEWS = {
    "panel": PANEL,
    "ticker_map": TICKER_MAP,
    "sectors": SECTORS,
    "targets": TARGETS,
    "matrix": MATRIX,
}

# Exchange code -> country, as a SQL map.
COUNTRY_MAP = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in scalar.COUNTRY_CODES.items()) + "}"

CANONICAL = f"""
case when len(string_split_regex(trim(bloomberg_ticker), '\\s+')) >= 2
      and {COUNTRY_MAP}[string_split_regex(trim(bloomberg_ticker), '\\s+')[-1]] is not null
     then string_split_regex(trim(bloomberg_ticker), '\\s+')[1] || ' ' ||
          {COUNTRY_MAP}[string_split_regex(trim(bloomberg_ticker), '\\s+')[-1]] end
"""


def over(*views: str, body: str, recursive: bool = False) -> str:
    """``body`` over the named fixture views."""
    named = ", ".join(f"{v} as ({VIEWS[v]})" for v in views)
    word = "with recursive" if recursive else "with"
    joiner = ", " if body.lstrip().startswith("@") else " "
    return f"{word} {named}{joiner}{body.lstrip().removeprefix('@')}"


def trailing(n: int) -> str:
    return f"(partition by ticker order by date rows between {n - 1} preceding and current row)"


def ema(name: str, source: str, n: int) -> str:
    """CTEs for the EMA of ``source`` (ticker, date, rn, x), rn counting from 1 per ticker."""
    return f"""
{name}_s as (
  select ticker, date, rn, x, avg(x) over (partition by ticker order by rn
         rows between {n - 1} preceding and current row) as seed from {source}),
{name} as (
  select ticker, date, rn, seed as y from {name}_s where rn = {n}
  union all
  select s.ticker, s.date, s.rn, s.x * (2.0::double / {n + 1}) + e.y * (1 - 2.0::double / {n + 1})
  from {name} e join {name}_s s on s.ticker = e.ticker and s.rn = e.rn + 1)"""


def chained(name: str, source: str, n: int) -> str:
    """The values of an EMA as the source of the next one."""
    return f"{name} as (select ticker, date, rn - {n - 1} as rn, y as x from {source})"


NUMBERED = """numbered as (
  select ticker, date, close as x, row_number() over (partition by ticker order by date) as rn
  from panel)"""


def _horner(x: str, coefficients: Sequence[float]) -> str:
    text = f"{coefficients[0]!r}::double"
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r}::double)"
    return text


def inverse_normal(p: str) -> str:
    """Algorithm AS 241 as one SQL expression."""
    q = f"({p} - 0.5)"
    r = f"sqrt(-ln(least({p}, 1.0 - {p})))"

    def ratio(x, top, bottom):
        return f"({_horner(x, top)} / {_horner(x, bottom)})"

    inner = ratio(f"(0.180625 - {q} * {q})", scalar.CENTRAL_TOP, scalar.CENTRAL_BOTTOM)
    middle = ratio(f"({r} - 1.6)", scalar.MIDDLE_TOP, scalar.MIDDLE_BOTTOM)
    tail = ratio(f"({r} - 5.0)", scalar.TAIL_TOP, scalar.TAIL_BOTTOM)
    return (
        f"case when {p} <= 0 or {p} >= 1 then null when abs({q}) <= 0.425 then {q} * {inner} "
        f"else sign({q}) * case when {r} <= 5.0 then {middle} else {tail} end end"
    )


def average_rank(x: str, part: str = "") -> str:
    by = f"partition by {part} " if part else ""
    tie = f"{part}, {x}" if part else x
    return (
        f"(rank() over ({by}order by {x}) + (count(*) over (partition by {tie}) - 1) / 2.0)"
    )


def edges(x: str) -> str:
    """Distinct linear-interpolated quintile edges of a group, as an aggregate.

    Written out, because quantile_cont gives equal neighbours a last digit that differs, so that one edge
    becomes two.
    """
    s = f"list_sort(list({x}) filter ({x} is not null))"
    return f"""list_sort(list_distinct(list_transform([0, 0.2, 0.4, 0.6, 0.8, 1]::double[],
      lambda p: case when {s}[floor(p * (len({s}) - 1))::int + 1] = {s}[ceil(p * (len({s}) - 1))::int + 1]
        then {s}[floor(p * (len({s}) - 1))::int + 1]
        else {s}[floor(p * (len({s}) - 1))::int + 1] * (ceil(p * (len({s}) - 1)) - p * (len({s}) - 1))
           + {s}[ceil(p * (len({s}) - 1))::int + 1] * (p * (len({s}) - 1) - floor(p * (len({s}) - 1)))
        end)))"""
