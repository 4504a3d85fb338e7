"""Sums and averages of doubles that are exact until one final rounding.

A double is a whole number of up to 53 bits times a power of two. It is cut into
six *limbs* of 21 bits, aligned to a fixed grid of powers of two, and the limbs
are added up as BIGINTs: that is exact, combines map-side and does not depend on
the order of the rows. Six limbs hold every bit of magnitudes from 2^-31 to 2^32
(the window that nearly all amounts lie in). Other magnitudes use the same six
limbs on a grid moved by multiples of 63 bits; the window number joins the
grouping key of the first aggregation, so ordinary data has as many groups as
before and any mixture of magnitudes stays exact.

Afterwards the windows of a group are laid over each other, carries are passed
on, the total is divided by the count digit by digit (averages), and the leading
digits are rounded to the nearest double, once.

Whole-number columns take the same way, so amounts beyond 2^53 lose nothing.
Values that are not finite add up as IEEE says (NaN, or infinities of one sign).
NULLs do not count; no value gives NULL. Exact up to 4e12 rows a group.

Everything is built-in expressions; only the final step, one evaluation per
group, uses higher-order functions.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMBS, LIMB_BITS = 6, 21
LOW_BIT = -84  # weight of the lowest limb's last bit in window 0
WINDOW_BITS = 3 * LIMB_BITS
_SMALL, _LARGE = 2.0 ** -31, 2.0 ** 32
_MASK, _BASE = (1 << LIMB_BITS) - 1, 1 << LIMB_BITS
_MAX = 1.7976931348623157e308


@dataclass(frozen=True)
class Measure:
    """An aggregate that ``kpi`` computes in two mergeable steps.

    ``kind``: ``sum`` or ``avg`` (exact, as a double), ``whole`` (sum of whole
    numbers as BIGINT, NULL beyond it) or ``rows`` (count of rows).
    """

    kind: str
    value: Column | None
    name: str = ""
    digits: int | None = None

    def alias(self, name: str) -> Measure:
        return replace(self, name=name)

    def rounded(self, digits: int) -> Measure:
        """Round the result HALF_UP to ``digits`` decimals (of its shortest decimal form)."""
        return replace(self, digits=digits)


_NEXT = 2 * LIMB_BITS + 1  # bits of the two digits and the mark that are added last


class _Input:
    """One distinct input column of exact measures; formulas are SQL text."""

    def __init__(self, i: int, value: Column, kind: T.DataType):
        self.i, self.value = i, value
        self.whole = isinstance(kind, T.IntegralType)
        if not self.whole and not isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
            raise TypeError(f"an exact sum needs a number, not {kind.simpleString()}")
        self.x, self.w, self.rest, self.n, self.odd, self.base, self.digits, self.sign, self.total, self.mean = (
            f"__{p}{i}" for p in ("x", "w", "rest", "n", "odd", "base", "digits", "sign", "total", "mean"))
        self.limbs = [f"__x{i}_{limb}" for limb in range(LIMBS)]

    # rows

    def split(self) -> list[dict[str, Column]]:
        """Columns to add to the rows, step by step: value, window, place in the window, limbs."""
        if self.whole:
            parts = ["0L", f"{self.x} & {_MASK}L", f"shiftright({self.x}, {LIMB_BITS}) & {_MASK}L",
                     f"shiftright({self.x}, {2 * LIMB_BITS})", "0L", "0L"]
            return [{self.x: self.value.cast("bigint")}, {}, {},
                    {c: F.expr(f"case when {self.x} is not null then {p} end") for c, p in zip(self.limbs, parts)},
                    *[{}] * (LIMBS - 1)]
        size = f"abs({self.x})"
        window = (f"case when {size} >= {_SMALL!r}D and {size} < {_LARGE!r}D then 0 when {size} > 0 and {size} <= {_MAX!r}D "
                  f"then cast(floor((log2({size}) + {-LOW_BIT - 53}) / {WINDOW_BITS}) as int) else 0 end")
        # a power of two changes no bit; two steps, since one factor could overflow
        placed = (f"case when {size} <= {_MAX!r}D then case when {self.w} = 0 then {self.x} "
                  f"else {self.x} * pow(2D, {self.w} * -32) * pow(2D, {self.w} * -31) end end")
        steps = [{self.x: self.value.cast("double")}, {self.w: F.expr(window)}, {self.rest: F.expr(placed)}]
        for limb in reversed(range(LIMBS)):
            unit = 2.0 ** (LOW_BIT + LIMB_BITS * limb)
            whole = f"cast({self.rest} * {1 / unit!r}D as bigint)"
            steps.append({self.limbs[limb]: F.expr(whole)} | ({self.rest: F.expr(f"{self.rest} - {whole} * {unit!r}D")} if limb else {}))
        return steps

    # groups

    def partial(self) -> list[Column]:
        odd = "cast(null as double)" if self.whole else f"sum(case when not abs({self.x}) <= {_MAX!r}D then {self.x} end)"
        return [*[F.sum(c).alias(c) for c in self.limbs], F.count(self.x).alias(self.n), F.expr(odd).alias(self.odd)]

    def merged(self) -> list[Column]:
        limbs = ", ".join(f"coalesce({c}, 0L)" for c in self.limbs)
        entry = f"collect_list(struct({'1' if self.whole else self.w} as w, array({limbs}) as q))"
        return [F.expr(entry).alias(self.x), F.sum(self.n).alias(self.n), F.sum(self.odd).alias(self.odd)]

    def totals(self) -> list[dict[str, Column]]:
        """Columns to add to the groups, step by step, up to the digits (base 2^21, low
        first) and the sign of the total."""
        windows = f"transform({self.x}, e -> e.w)"
        laid = (f"transform(sequence(0, 3 * (array_max({windows}) - {self.base}) + {LIMBS + 2}), at -> aggregate({self.x}, 0L, "
                f"(acc, e) -> acc + coalesce(get(e.q, at - 3 * (e.w - {self.base})), 0L)))")
        # a negative total is what its digits say less one unit above them all: negated, the complement
        return [
            {self.base: F.expr(f"array_min({windows})")},
            {self.digits: F.expr(laid)},
            {self.digits: F.expr(_carried(self.digits))},
            {self.sign: F.expr(f"if({self.digits}.carry < 0, -1D, 1D)")},
            {self.digits: F.expr(f"if({self.sign} < 0, {_carried(f'transform({self.digits}.out, d -> -d)')}.out, {self.digits}.out)")},
        ]

    def results(self, kinds: set[str]) -> dict[str, Column]:
        out = {}
        for kind, name, by in (("sum", self.total, "1L"), ("avg", self.mean, f"if({self.n} > 0, {self.n}, null)")):
            if kind in kinds:
                exact = f"{self.sign} * {_nearest(self.digits, by, self.base)}"
                out[name] = F.expr(f"if({self.n} > 0, coalesce({self.odd}, {exact}), null)")
        return out


def _carried(digits: str) -> str:
    """``(carry, out)``: the array with every digit in 0 .. 2^21 - 1, and what is left over at the top."""
    return (f"aggregate({digits}, named_struct('carry', 0L, 'out', cast(array() as array<bigint>)), (s, d) -> named_struct("
            f"'carry', shiftright(s.carry + d, {LIMB_BITS}), 'out', concat(s.out, array((s.carry + d) & {_MASK}L))))")


def _nearest(digits: str, by: str, base: str) -> str:
    """The double nearest to digits / by: long division, then the four leading digits and
    whether anything follows them, in one addition that rounds."""
    spare = 5  # digits after the point, so that four follow the leading one
    turn = f"(s.rest * {_BASE}L + d)"
    divided = (f"aggregate(concat(reverse({digits}), array_repeat(0L, {spare})), "
               f"named_struct('rest', 0L, 'out', cast(array() as array<bigint>)), (s, d) -> named_struct("
               f"'rest', {turn} % {by}, 'out', concat(s.out, array({turn} div {by}))))")
    # arrays of one element bind a name: the division, then the place of its leading digit
    at = [f"coalesce(get(v.r.out, v.lead + {j}), 0L)" for j in range(4)]
    follows = "if(exists(slice(v.r.out, v.lead + 5, size(v.r.out)), d -> d > 0) or v.r.rest > 0, 1, 0)"
    whole = (f"(cast({at[0]} * {_BASE}L + {at[1]} as double) * {2.0 ** _NEXT!r}D "
             f"+ cast(({at[2]} * {_BASE}L + {at[3]}) * 2 + {follows} as double))")
    # weight of the last bit of that sum; two factors, since one could overflow
    last = f"((size(v.r.out) - 4 - v.lead - {spare}) * {LIMB_BITS} + {base} * {WINDOW_BITS} + {LOW_BIT - 1})"
    value = f"{whole} * pow(2D, {last} div 2) * pow(2D, {last} - {last} div 2)"
    lead = "named_struct('r', r, 'lead', cast(array_position(transform(r.out, d -> d > 0), true) as int) - 1)"
    return f"get(transform(transform(array({divided}), r -> {lead}), v -> if(v.lead < 0, 0D, {value})), 0)"


def _add(df: DataFrame, steps: list[list[dict[str, Column]]]) -> DataFrame:
    """The columns of all inputs, one projection per step."""
    for step in zip(*steps):
        columns = {name: c for part in step for name, c in part.items()}
        df = df.withColumns(columns) if columns else df
    return df


def exact_measures(df: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """``keys`` and the named ``measures`` of their groups (two aggregations, one pass over ``df``)."""
    inputs: dict[str, _Input] = {}
    kinds: dict[str, set[str]] = {}
    for m in measures:
        if m.kind in ("sum", "avg"):
            text = str(m.value)
            if text not in inputs:
                inputs[text] = _Input(len(inputs), m.value, df.select(m.value.alias("x")).schema["x"].dataType)
            kinds.setdefault(text, set()).add(m.kind)
    use = list(inputs.values())
    df = _add(df, [x.split() for x in use])
    first = [c for x in use for c in x.partial()]
    second = [c for x in use for c in x.merged()]
    for j, m in enumerate(measures):
        if m.kind == "rows":
            first.append(F.count(F.lit(1)).alias(f"__m{j}"))
            second.append(F.sum(f"__m{j}").alias(f"__m{j}"))
        elif m.kind == "whole":
            first.append(F.sum(m.value.cast("decimal(20,0)")).alias(f"__m{j}"))
            second.append(F.sum(F.col(f"__m{j}").try_cast("decimal(38,0)")).alias(f"__m{j}"))
    windows = [x.w for x in use if not x.whole]
    out = df.groupBy(*keys, *windows).agg(*first).groupBy(*keys).agg(*second)
    out = _add(out, [[*x.totals(), x.results(kinds[text])] for text, x in inputs.items()])
    columns = []
    for j, m in enumerate(measures):
        if m.kind == "rows":
            c = F.col(f"__m{j}")
        elif m.kind == "whole":
            c = F.col(f"__m{j}").try_cast("bigint")
        else:
            x = inputs[str(m.value)]
            c = F.col(x.total if m.kind == "sum" else x.mean)
            c = c if m.digits is None else F.round(c, m.digits)
        columns.append(c.alias(m.name))
    return out.select(*keys, *columns)
