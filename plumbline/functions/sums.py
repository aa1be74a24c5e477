"""Sums that are exact, whatever the values and in whatever order Spark adds them up.

A sum of doubles changes in its last digits with the partitioning, so two equal tables
could differ. Every value is therefore added as the decimal that its text shows, in parts
that cannot be rounded, and totals are compared as they are, also across types:

- integers and decimals of at most 28 digits as decimals;
- longer decimals in four limbs of 18 digits;
- doubles from 0.001 up to 10^15, nearly all there are, in whole numbers, ten places after the
  point and ten more. Whole millionths of at most 15 digits are taken apart without their text;
- any other finite double, from its text, in three limbs of ten digits that begin at a multiple of
  ten places. It is put on a row of its own, and such rows are grouped by column and place; no
  other row is, and columns do not multiply each other's groups.

Only NaN and infinity have no exact sum. The few totals of a run are put together and
compared by a small function over one row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.names import name_sql

# Doubles of up to 15 digits, six of them after the point, are whole millionths.
SHORT_PLACES, SHORT_DIGITS = 6, 15
# Whole numbers are added in pieces of so many bits: their sums fit a long up to 10^13 rows.
PIECE_BITS = 17

# Doubles in this range have at most 20 places after the point and 15 digits before it, and no
# leading zeros that their text leaves out.
LEAST, MOST = 1e-3, 1e15
PLACES = 10

# Sums of the limbs of rare values, in pieces: name, SQL, power of two, limb.
RARE_SUMS = [
    (f"__sum{i}_{piece}", sql, PIECE_BITS * piece, i)
    for i in range(3)
    for piece, sql in enumerate(
        (f"__l{i} & {2**PIECE_BITS - 1}", f"shiftright(__l{i}, {PIECE_BITS})")
    )
]

# Decimals of up to 28 digits leave ten digits for the number of rows in a sum of 38.
SUMMED_DIGITS = 28
LIMB_DIGITS, LIMBS = 18, 4


@dataclass(frozen=True)
class SumParts:
    """SQL for the parts of one column's sum. ``inputs`` are read from the table, ``derived``
    and the others from the columns before them."""

    name: str
    inputs: list[tuple[str, str]]
    derived: list[tuple[str, str]]
    aggregates: list[tuple[str, str]]
    """Names and sums; rows and groups are put together by adding them up."""
    terms: list[tuple[str, int, int]]
    """Those of the aggregates that make up the total, each times a power of two and one of ten."""
    scale: int
    """Places after the point that decimals show."""
    kind: str
    """``integer``, ``decimal`` or ``float``."""
    rare: str | None = None
    """Text of a value that goes on a row of its own; null for others."""


@dataclass(frozen=True)
class Rows:
    """What to take from a table in one scan: SQL for its columns and their sums."""

    inputs: list[tuple[str, str]] = field(default_factory=list)
    derived: list[tuple[str, str]] = field(default_factory=list)
    rares: list[tuple[str, str]] = field(default_factory=list)
    aggregates: list[tuple[str, str]] = field(default_factory=list)


def sum_parts(name: str, value: str, data_type: T.DataType) -> SumParts:
    """Parts of the sum of the SQL ``value``; all their names begin with ``name``."""
    v, counted = f"{name}_v", (f"{name}_n", f"count({name}_v)")
    if isinstance(data_type, T.IntegralType) or (
        isinstance(data_type, T.DecimalType) and data_type.precision <= SUMMED_DIGITS
    ):
        scale = getattr(data_type, "scale", 0)
        total = (f"{name}_all", f"sum(CAST({v} AS DECIMAL({SUMMED_DIGITS}, {scale})))")
        kind = "decimal" if isinstance(data_type, T.DecimalType) else "integer"
        return SumParts(
            name, [(v, value)], [], [counted, total], [(f"{name}_all", 0, 0)], scale, kind
        )
    if isinstance(data_type, T.DecimalType):
        return _long_decimal_parts(name, value, counted, data_type.scale)
    return _double_parts(name, f"CAST({value} AS DOUBLE)", counted)


def _long_decimal_parts(
    name: str, value: str, counted: tuple[str, str], scale: int
) -> SumParts:
    v, t, m, d = (f"{name}_{c}" for c in "vtmd")
    power = f"CASE WHEN contains({t}, 'E') THEN CAST(substring_index({t}, 'E', -1) AS INT) ELSE 0 END"
    places = f"CASE WHEN contains({m}, '.') THEN length(substring_index({m}, '.', -1)) ELSE 0 END"
    digits = f"replace(trim(LEADING '-' FROM {m}), '.', '')"
    width = LIMB_DIGITS * LIMBS
    derived = [
        (t, f"CAST({v} AS STRING)"),
        (m, f"substring_index({t}, 'E', 1)"),
        (d, f"lpad({digits} || repeat('0', {power} - {places} + {scale}), {width}, '0')"),
    ]
    sign = f"(CASE WHEN {v} < 0 THEN -1 ELSE 1 END)"
    sums, terms = [counted], []
    for i in range(LIMBS):
        first = width - LIMB_DIGITS * (i + 1) + 1
        part = f"CAST(substring({d}, {first}, {LIMB_DIGITS}) AS BIGINT) * {sign}"
        sums.append((f"{name}_l{i}", f"sum(CAST({part} AS DECIMAL({SUMMED_DIGITS}, 0)))"))
        terms.append((f"{name}_l{i}", 0, LIMB_DIGITS * i - scale))
    return SumParts(name, [(v, value)], derived, sums, terms, scale, "decimal")


def _power_of_ten(exponent: str) -> str:
    """Ten to the SQL ``exponent`` as a long; null below 0 and above 18, also where Spark works it
    out before it knows whether a branch is taken."""
    return f"get(array({', '.join(f'{10**i}L' for i in range(19))}), {exponent})"


def _double_parts(name: str, value: str, counted: tuple[str, str]) -> SumParts:
    """A double that is a whole number of millionths, of 15 digits at most, is the only short
    decimal at that double, so that the whole number can be taken instead of its text. Of others
    the text gives the places after the point. The whole part is the double's own: no decimal
    that reads as a double lies beyond the next whole number, which is a double too.
    """
    v, w, t, p, i, f, g = (f"{name}_{c}" for c in "vwtpifg")
    bound, unit = float(10 ** (SHORT_DIGITS - SHORT_PLACES)), float(10**SHORT_PLACES)
    whole = f"CASE WHEN abs({v}) < {bound}D THEN CAST(rint({v} * {unit}D) AS BIGINT) END"
    inside = f"abs({v}) >= {LEAST!r}D AND abs({v}) < {MOST!r}D"
    finite = f"NOT isnan({v}) AND abs({v}) <= 1.7976931348623157E308D"
    # In the text of a number from 10^7 on the point stands after the first digit.
    moved = (
        f"substring(substring_index({t}, 'E', 1), "
        f"instr({t}, '.') + 1 + CAST(substring_index({t}, 'E', -1) AS INT))"
    )
    after = f"CASE WHEN abs({v}) < 1.0E7D THEN substring_index({t}, '.', -1) ELSE {moved} END"
    sign = f"CASE WHEN {v} < 0 THEN -1L ELSE 1L END"
    derived = [
        (w, f"CASE WHEN CAST({whole} AS DOUBLE) / {unit}D = {v} THEN {whole} END"),
        (t, f"CASE WHEN {w} IS NULL AND {inside} THEN CAST({v} AS STRING) END"),
        (p, f"rpad({after}, {2 * PLACES}, '0')"),
        (i, f"CASE WHEN {w} IS NOT NULL OR {t} IS NOT NULL THEN CAST({v} AS BIGINT) END"),
        (
            f,
            f"CASE WHEN {w} IS NOT NULL THEN ({w} % {10**SHORT_PLACES}L) "
            f"* {10 ** (PLACES - SHORT_PLACES)}L "
            f"ELSE CAST(substring({p}, 1, {PLACES}) AS BIGINT) * {sign} END",
        ),
        (g, f"CAST(substring({p}, {PLACES + 1}, {PLACES}) AS BIGINT) * {sign}"),
    ]
    sums, terms = [counted], []
    for part, pieces, tens in ((i, 3, 0), (f, 2, -PLACES), (g, 2, -2 * PLACES)):
        for piece in range(pieces):
            high = f"shiftright({part}, {PIECE_BITS * piece})" if piece else part
            low = f"{high} & {2**PIECE_BITS - 1}"
            sums.append((f"{part}{piece}", f"sum({low if piece < pieces - 1 else high})"))
            terms.append((f"{part}{piece}", PIECE_BITS * piece, tens))
    sums.append((f"{name}_bad", f"count(CASE WHEN NOT ({finite}) THEN {v} END)"))
    rare = f"CASE WHEN {i} IS NULL AND {finite} THEN CAST({v} AS STRING) END"
    return SumParts(name, [(v, value)], derived, sums, terms, SHORT_PLACES, "float", rare)


def _rare_rows(frame: DataFrame, rares: list[tuple[str, str]]) -> DataFrame:
    """Further rows for rare values: ``__pos`` above 0, ``__of``, the column, ``__place``, and limbs."""
    texts = [f"__rare_{i}" for i in range(len(rares))]
    for text, (_, sql) in zip(texts, rares, strict=True):
        frame = frame.withColumn(text, F.expr(sql))
    every = ", ".join(
        f"named_struct('of', '{name}', 't', {text})"
        for text, (name, _) in zip(texts, rares, strict=True)
    )
    some = " OR ".join(f"{text} IS NOT NULL" for text in texts)
    rows = f"CASE WHEN {some} THEN filter(array({every}), x -> x.t IS NOT NULL) END"
    frame = frame.withColumn("__rows", F.expr(rows))
    frame = frame.selectExpr("*", "posexplode_outer(__rows) AS (__pos, __row)")
    steps = [
        ("__of", "__row.of"),
        ("__t", "__row.t"),
        ("__m", "CASE WHEN contains(__t, 'E') THEN substring_index(__t, 'E', 1) ELSE __t END"),
        (
            "__k",
            "octet_length(__m) - instr(__m, '.') - "
            "CASE WHEN contains(__t, 'E') THEN CAST(substring_index(__t, 'E', -1) AS INT) ELSE 0 END",
        ),
        ("__d", "CAST(replace(__m, '.', '') AS BIGINT)"),
        # The value is __d * 10^__up at a place that is a multiple of ten.
        ("__place", f"CAST(floor(-__k / {PLACES}.0D) AS INT)"),
        ("__up", f"-__k - {PLACES} * __place"),
        ("__high", f"__d div {_power_of_ten(f'({PLACES} - __up)')}"),
        ("__l0", f"(__d % {_power_of_ten(f'({PLACES} - __up)')}) * {_power_of_ten('__up')}"),
        ("__l1", f"__high % {10**PLACES}L"),
        ("__l2", f"__high div {10**PLACES}L"),
    ]
    for name, sql in steps:
        frame = frame.withColumn(name, F.expr(sql))
    return frame


def width(parts: SumParts) -> int:
    """Fields of Spark's projection or aggregation for the parts; a decimal sum takes two."""
    buffers = sum(1 + ("DECIMAL" in sql) for _, sql in parts.aggregates) + bool(parts.rare)
    return max(len(parts.inputs) + len(parts.derived), buffers)


def gathered(parts: SumParts) -> str:
    """SQL, over the groups of rows, for one struct with all that the total is made of."""
    name, sums = parts.name, dict(parts.aggregates)
    bad = f"coalesce(sum({name}_bad), 0)" if f"{name}_bad" in sums else "0L"
    terms = [
        f"concat_ws(' ', CAST(sum({term}) AS STRING), '{twos}', '{tens}')"
        if "DECIMAL" in sums[term]
        else f"concat_ws(' ', CAST(sum(CAST({term} AS DECIMAL({SUMMED_DIGITS}, 0))) AS STRING), "
        f"'{twos}', '{tens}')"
        for term, twos, tens in parts.terms
    ]
    every = f"array({', '.join(terms)})"
    if parts.rare:
        own = ", ".join(
            f"concat_ws(' ', CAST({sum_} AS STRING), '{twos}', CAST({PLACES} * (__place + {i}) AS STRING))"
            for sum_, _, twos, i in RARE_SUMS
        )
        every = f"concat({every}, flatten(collect_list(CASE WHEN __of = '{name}' THEN array({own}) END)))"
    return (
        f"named_struct('n', CAST(coalesce(sum({name}_n), 0) AS BIGINT), 'bad', CAST({bad} AS BIGINT), "
        f"'terms', {every}, 'scale', {parts.scale}, 'kind', '{parts.kind}') AS {name}"
    )


def compared(source: Column, target: Column, plain: bool, tolerance: float) -> Column:
    """Two gathered sums: their texts without exponent, the gap, and whether it is small enough.

    ``plain`` writes whole numbers and decimals as such, otherwise all totals as floats.
    """

    def run(one, two):
        # Self-contained, so that the tasks need nothing but Python.
        from decimal import Context, Decimal, Inexact, localcontext

        def total(parts):
            out = Decimal(0)
            for term in parts.terms or ():
                value, *powers = term.split()
                if len(powers) == 2:  # otherwise a sum of no values
                    out += (Decimal(value) * 2 ** int(powers[0])).scaleb(int(powers[1]))
            return out

        def text(value, parts):
            if value == 0:  # a missing total too is written as a float zero
                return "0.0"
            if plain and parts.kind == "integer":
                return f"{value:.0f}"
            if plain and parts.kind == "decimal":
                return f"{value:.{parts.scale}f}"
            whole, _, places = f"{value:f}".partition(".")
            return f"{whole}.{places.rstrip('0') or '0'}"

        with localcontext(Context(prec=1200, Emax=100000, Emin=-100000, traps=[Inexact])):
            a, b = total(one), total(two)
            gap = abs(a - b)
            equal = gap == 0 or gap <= Decimal(repr(float(tolerance)))
            return text(a, one), text(b, two), float(gap), equal

    shape = "struct<source: string, target: string, gap: double, equal: boolean>"
    return F.udf(run, shape)(source, target)


def one_row(df: DataFrame, rows: Rows, outputs: list[str]) -> DataFrame:
    """One row of ``outputs``, SQL over the groups of rows: all of them, and those of rare values."""
    frame = df.selectExpr(*[f"{sql} AS {name}" for name, sql in rows.inputs]) if rows.inputs else df
    for name, sql in rows.derived:
        frame = frame.withColumn(name, F.expr(sql))
    if not rows.rares:
        aggregates = [F.expr(f"{sql} AS {name}") for name, sql in rows.aggregates]
        return frame.groupBy().agg(*aggregates).agg(*[F.expr(sql) for sql in outputs])
    own = "FILTER (WHERE __pos IS NULL OR __pos = 0)"
    aggregates = [F.expr(f"{sql} {own} AS {name}") for name, sql in rows.aggregates]
    limbs = [F.expr(f"sum({sql}) AS {name}") for name, sql, _, _ in RARE_SUMS]
    grouped = _rare_rows(frame, rows.rares).groupBy("__of", "__place").agg(*aggregates, *limbs)
    return grouped.agg(*[F.expr(sql) for sql in outputs])


def exact_sums(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the exact sum of each column as text without exponent, under the column's name."""
    values = [name_sql(df, c) for c in columns]
    types = [f.dataType for f in df.select(*[F.col(v) for v in values]).schema]
    own = [sum_parts(f"s{i}", v, t) for i, (v, t) in enumerate(zip(values, types, strict=True))]
    rows = Rows(
        [x for p in own for x in p.inputs],
        [x for p in own for x in p.derived],
        [(p.name, p.rare) for p in own if p.rare],
        [x for p in own for x in p.aggregates],
    )
    row = one_row(df, rows, [gathered(p) for p in own])
    sums = [compared(F.col(p.name), F.col(p.name), True, 0) for p in own]
    return row.select(*[s["source"].alias(c) for s, c in zip(sums, columns, strict=True)])
