"""Grouped pay statistics (F1, F5-F8) with exact, interpolated quantiles in bounded memory and few shuffles.

Two passes over the rows. The first sketches each key (``percentile_approx``, combined in the tasks) and so brackets every
wanted quantile between two values that are sure to enclose its rank. The second sums up what lies outside the brackets
in the tasks, a row a gap, and ships only values inside them, counted; running counts then give the exact ranks. What is
shuffled are a key's sketches and about ``4 * MARGIN`` of its rows a quantile, wherever a hot key's rows lie.

Brackets go to the tasks by broadcast, for the ``HEAVY`` largest keys, which bounds it. Every other key holds at most a
``HEAVY``-th of all rows; its values are all counted, as are those of a key with up to ``WHOLE`` values, so results are
exact whatever the keys. NULL is a key like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ``accuracy`` of the sketch: its ranks are off by a ACCURACY-th of the key's values at most.
ACCURACY = 10_000
#: Share of a key's values between a wanted rank and either end of its bracket; twenty times what the sketch may be off.
MARGIN = 20 / ACCURACY
#: Keys with up to so many values need no bracket.
WHOLE = 10_000
#: Keys that get brackets; every other key holds at most a HEAVY-th of all rows.
HEAVY = 1000

# Stat spec: "count" | "count_distinct:<col>" | "avg" | "min" | "max" | "median" | float quantile
Spec = str | float


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``a`` joined to ``b`` on ``keys``, NULL matching NULL; the columns of ``a``, then the others of ``b``."""
    other = b.selectExpr(*[f"`{k}` as `_r_{k}`" for k in keys], *[f"`{c}`" for c in b.columns if c not in keys])
    return a.join(other, F.expr(" and ".join(f"`{k}` <=> `_r_{k}`" for k in keys)), how).drop(*[f"_r_{k}" for k in keys])


def _brackets(rows: DataFrame, keys: Sequence[str], places: Sequence[float]) -> DataFrame:
    """keys, _lo, _hi (arrays, an entry a place; NULL: open) of the largest keys that have more than WHOLE values in ``_v``."""
    lows, highs = [max(p - MARGIN, 0.0) for p in places], [min(p + MARGIN, 1.0) for p in places]
    g = rows.where("_v is not null").groupBy(*keys).agg(
        F.expr("count(1) as _values"), F.expr(f"percentile_approx(_v, array({', '.join(f'{p}D' for p in lows + highs)}), {ACCURACY}) as _s"))
    ends = lambda at, probs, open_: ", ".join("cast(null as double)" if p == open_ else f"_s[{at + i}]" for i, p in enumerate(probs))
    top = g.where(f"_values > {WHOLE}").orderBy("_values", ascending=False).limit(HEAVY)
    return top.selectExpr(*[f"`{k}`" for k in keys], f"array({ends(0, lows, 0.0)}) as _lo", f"array({ends(len(lows), highs, 1.0)}) as _hi")


def with_quantiles(rows: DataFrame, keys: Sequence[str], sums: Mapping[str, str], least: Mapping[str, str], most: Mapping[str, str],
                   quantiles: Mapping[str, float], id_col: str | None = None, id_name: str = "_ids", weight: str | None = None) -> DataFrame:
    """Per key: the ``sums``, minima and maxima of SQL expressions over ``rows``, and the quantiles of ``_v``.

    Quantiles are interpolated between the two ranks around ``p * (n - 1)`` of the non-NULL values; a key without a value has
    NULL quantiles. ``id_col``: also the distinct non-NULL ids, as ``id_name``. ``weight``: for how many equal rows a row stands.
    """
    places = list(dict.fromkeys(quantiles.values()))
    names = [f"`{k}`" for k in keys]
    src = rows
    if places:
        sketched = rows if not weight else _repeated(rows, weight)
        src = same_keys(rows, F.broadcast(_brackets(sketched.select(*keys, "_v"), keys, places)), keys)      # HEAVY rows at most
        inside = " or ".join(f"((_lo[{i}] is null or _v >= _lo[{i}]) and (_hi[{i}] is null or _v <= _hi[{i}]))" for i in range(len(places)))
        below = ", ".join(f"if(_hi[{i}] < _v, _hi[{i}], null)" for i in range(len(places)))
        src = src.selectExpr("*", f"_lo is not null and _v is not null and not ({inside}) as _gap")
        # a value in a bracket stands for itself; all of a gap for the end of the bracket below it (NULL: none is below)
        src = src.selectExpr("*", f"if(_gap, greatest({below}, null), _v) as _g")
    group = [*names, *(["_gap", "_g"] if places else [])]
    counted = {"_n": f"if(_v is not null, {weight or '1L'}, null)"} if places else {}
    cells = {**counted, **sums, **least, **most}
    src = src.selectExpr(*group, *[f"{c} as `{name}`" for name, c in cells.items()], *([f"`{id_col}` as _id"] if id_col else []))
    add = [F.expr(f"{fn}(`{c}`) as `{c}`") for fn, of in (("sum", counted), ("sum", sums), ("min", least), ("max", most)) for c in of]
    if id_col:
        # each row once for its value and once for its id alone, so that one shuffle serves the counts and the distinct ids
        types = dict(src.dtypes)
        own = [*(["_gap", "_g"] if places else []), *cells]
        full = "named_struct(" + ", ".join(f"'{c}', `{c}`" for c in own) + f", '_id', cast(null as {types['_id']}))"
        alone = "named_struct(" + ", ".join(f"'{c}', " + ("false" if c == "_gap" else f"cast(null as {types[c]})") for c in own) + ", '_id', _id)"
        two = src.selectExpr(*names, f"explode(if(_id is null, array({full}), array({full}, {alone}))) as _r").selectExpr(*names, "_r.*")
        pairs = two.groupBy(*[g.strip("`") for g in group], "_id").agg(*add)
        src = pairs.selectExpr("*", f"if(_id is null, 0L, 1L) as {id_name}")
        add.append(F.expr(f"sum({id_name}) as {id_name}"))
    out = src.groupBy(*[g.strip("`") for g in group]).agg(*add)
    if not places:
        return out
    of = ", ".join(names)
    out = out.selectExpr("*", f"sum(_n) over (partition by {of}) as _t",
                         f"sum(coalesce(_n, 0L)) over (partition by {of} order by _g asc nulls first, _gap rows between unbounded preceding and current row) as _upto")

    def at(p: float, fn: str) -> str:
        here = f"cast({fn}({p}D * (_t - 1)) as bigint)"
        here = f"{here} >= _upto - _n and {here} < _upto"
        return f"max(if({here}, if(_gap, cast(raise_error('a rank lies outside its bracket') as double), _g), null))"

    ranks = [F.expr(f"{at(p, fn)} as _{i}_{side}") for i, p in enumerate(places) for side, fn in ((0, "floor"), (1, "ceil"))]
    out = out.groupBy(*keys).agg(*add, F.expr("max(_t) as _t"), *ranks)

    def value(p: float) -> str:
        i = places.index(p)
        return f"_{i}_0 + ({p}D * (_t - 1) - floor({p}D * (_t - 1))) * (_{i}_1 - _{i}_0)"

    kept = [f"`{c}`" for c in (*sums, *least, *most)]
    return out.selectExpr(*names, *kept, *([id_name] if id_col else []), *[f"{value(p)} as `{name}`" for name, p in quantiles.items()])


def _repeated(rows: DataFrame, weight: str) -> DataFrame:
    """Each row as often as its weight says, in two steps so that no array is long."""
    step = 4096
    n = F.col(weight).cast("long")
    parts = rows.where(n > 0).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / step))))
    return parts.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.least(F.lit(step), n - F.col("_part") * step).cast("int")))).drop("_part", "_copy")


def salary_stats(df: DataFrame, keys: Sequence[str], value: str, stats: Mapping[str, Spec], digits: int | None = 0) -> DataFrame:
    """``groupBy(keys)`` with named stats, rounded to ``digits`` (None: no rounding)."""
    quantiles = {n: 0.5 if spec == "median" else spec for n, spec in stats.items() if spec == "median" or isinstance(spec, float)}
    distinct = {n: spec.split(":", 1)[1] for n, spec in stats.items() if isinstance(spec, str) and spec.startswith("count_distinct:")}
    rows = df.select(*keys, F.expr(f"cast(`{value}` as double) as _v"))
    got = with_quantiles(rows, keys, {"_rows": "1L", "_filled": "if(_v is not null, 1L, null)", "_sum": "_v"}, {"_min": "_v"}, {"_max": "_v"}, quantiles)
    if distinct:
        got = same_keys(got, df.groupBy(*keys).agg(*[F.count_distinct(c).alias(n) for n, c in distinct.items()]), keys)
    plain = {"count": "_rows", "avg": "_sum / _filled", "min": "_min", "max": "_max"}

    def final(name: str, spec: Spec) -> str:
        c = plain.get(spec, f"`{name}`") if isinstance(spec, str) else f"`{name}`"
        return f"{c if spec == 'count' or name in distinct or digits is None else f'round({c}, {digits})'} as `{name}`"

    return got.selectExpr(*[f"`{k}`" for k in keys], *[final(n, spec) for n, spec in stats.items()])


def distinct_with_stats(df: DataFrame, keys: Sequence[str], id_col: str, value: str | None, count_name: str = "job_count",
                        avg_name: str | None = None, quantiles: Mapping[str, float] | None = None,
                        counts: Mapping[str, Column] | None = None, mins: Mapping[str, str] | None = None,
                        digits: int | None = 0, weight: str | None = None, once: str | None = None) -> DataFrame:
    """Per key: ``count(distinct id)`` plus avg / exact quantiles / conditional counts / mins over all rows.

    ``weight`` names a column that says for how many equal rows each row stands. ``once`` names a flag of rows that are known
    to be the only ones of their key and id: they are counted as they are, and only the ids of the others are shuffled.
    """
    counts, mins, quantiles = dict(counts or {}), dict(mins or {}), dict(quantiles or {})
    flags, lows = [f"_c{i}" for i in range(len(counts))], [f"_m{i}" for i in range(len(mins))]
    rows = df.select(*keys, F.expr(f"`{id_col}` as _of"), F.expr(f"if({f'`{once}`' if once else 'false'} and `{id_col}` is not null, 1L, 0L) as _o"),
                     F.expr(f"cast({f'`{value}`' if value else 'null'} as double) as _v"),
                     F.expr(f"cast({f'`{weight}`' if weight else 1} as bigint) as _w"), *[c.alias(f) for f, c in zip(flags, counts.values())],
                     *[F.expr(f"`{c}` as `{m}`") for m, c in zip(lows, mins.values())])
    sums = {"_filled": "if(_v is not null, _w, null)", "_sum": "_v * _w", **({"_once": "_o"} if once else {}), **{f: f"if(`{f}`, _w, 0L)" for f in flags}}
    got = with_quantiles(rows, keys, sums, {m: f"`{m}`" for m in lows}, {}, quantiles, None if once else "_of", "_ids", "_w" if weight else None)
    if once:
        pairs = df.where(f"not `{once}`").groupBy(*keys, id_col).agg(F.expr(f"if(`{id_col}` is null, 0L, 1L) as _id"))
        got = same_keys(got, pairs.groupBy(*keys).agg(F.sum("_id").alias("_ids")), keys)
    rounded = lambda c: f"round({c}, {digits})" if digits is not None else c
    return got.selectExpr(*[f"`{k}`" for k in keys], f"{'coalesce(_ids, 0L) + _once' if once else '_ids'} as `{count_name}`", *([f"{rounded('_sum / _filled')} as `{avg_name}`"] if avg_name else []),
                          *[f"{rounded(f'`{q}`')} as `{q}`" for q in quantiles], *[f"`{f}` as `{c}`" for f, c in zip(flags, counts)],
                          *[f"`{m}` as `{name}`" for m, name in zip(lows, mins)])
