"""Foreign-key resolution: single, composite, array-valued, date-interval,
first-of-many, prioritised cascade and enrichment joins.

Dimensions are reduced to one row per key before joining, so a join can
never multiply fact rows.  No join is forced to broadcast unless the side
has a proven bound; otherwise AQE measures the reduced dimension at run time
and converts to a broadcast hash join when it is small (falling back to a
sort-merge join with skew splitting when it is not).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relnorm.functions._util import as_col
from relnorm.operators.dedupe import dimension_index, keep_first
from relnorm.session import stage


def _pairs(on):
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, dict):
        return list(on.items())
    return [(p, p) if isinstance(p, str) else tuple(p) for p in on]


#: A dimension is broadcast on request only up to this counted size.
BROADCAST_BYTES = 8 << 20


def _bytes_of(df: DataFrame) -> int:
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16
                                        for c in df.columns])
    return df.agg(F.sum(width)).first()[0] or 0


def resolve_fk(df: DataFrame, dim: DataFrame, on, pk: str = "pk", as_name: str | None = None,
               keep: str = "last", policy: str = "null", drop_keys: bool = False,
               broadcast: bool = False, checks=None) -> DataFrame:
    """Replace natural key(s) by the dimension's ``pk``.

    ``on``: a column name, a list of names / (left, right) pairs, or a dict
    left → right.  Several keys compare column by column (no string
    concatenation, so ``a-b``/``c`` can't collide with ``a``/``b-c``).
    ``policy``: ``null`` keeps NULL for an unresolved key; ``strict`` raises
    when a non-blank key is unresolved; ``quarantine`` adds
    ``<as_name>_error``, set when a non-blank key is unresolved (see
    ``audit.split_by_error``).
    ``checks``: unresolved keys are measured where the result is written (see
    ``checks.Checks``), under ``unresolved <as_name>``; with ``strict`` its
    ``verify`` raises.  Without it ``strict`` runs one counting job now.
    ``broadcast``: for a dimension expected to be small whose key may be hot in
    ``df``; its size is counted, and beyond ``BROADCAST_BYTES`` the join is left
    to AQE like any other.
    """
    if policy not in ("null", "strict", "quarantine"):
        raise ValueError(f"unknown policy {policy}")
    pairs = _pairs(on)
    as_name = as_name or pk
    idx = dimension_index(dim, [r for _, r in pairs], pk, keep)
    tmp = {r: f"_fk_r{i}" for i, (_, r) in enumerate(pairs)}
    idx = idx.select(*[F.col(r).alias(t) for r, t in tmp.items()], F.col(pk).alias("_fk_pk"))
    if broadcast and _bytes_of(idx) <= BROADCAST_BYTES:
        idx = F.broadcast(idx)
    cond = reduce(lambda a, b: a & b, [df[l] == idx[tmp[r]] for l, r in pairs])
    out = df.join(idx, cond, "left").drop(*tmp.values()).withColumnRenamed("_fk_pk", as_name)
    present = reduce(lambda a, b: a & b,
                     [F.col(l).isNotNull() & (F.col(l).cast("string") != "") for l, _ in pairs])
    unresolved = present & F.col(as_name).isNull()
    if policy == "quarantine":
        out = out.withColumn(f"{as_name}_error", F.when(unresolved, F.lit(f"unresolved {as_name}")))
    if checks is not None:
        out = checks.watch(out, f"unresolved {as_name}", unresolved, [l for l, _ in pairs], policy == "strict")
    elif policy == "strict":
        from relnorm.operators.audit import fail_if_any
        fail_if_any(out.filter(unresolved).select(*[l for l, _ in pairs]), f"unresolved foreign key {as_name}")
    if drop_keys:
        out = out.drop(*[l for l, _ in pairs if l != as_name])
    return out


def resolve_array_fk(df: DataFrame, array_col: str, dim: DataFrame, label: str, pk: str = "pk",
                     as_name: str | None = None, keep: str = "last", stage_input: bool = True) -> DataFrame:
    """Array of labels → array of pks; order and duplicates kept; ``[]`` and
    NULL arrays give ``[]``; an unknown label gives a NULL element.

    Lists repeat far more than rows do, so only the distinct arrays (named by
    a digest) are exploded, resolved and put together again; the rows of
    ``df`` cross one join with that dictionary and are never regrouped.
    ``stage_input=False`` skips staging when ``df`` is a staged table anyway.
    """
    as_name = as_name or f"{array_col}_ids"
    df = df.withColumn("_af_key", F.md5(F.to_json(F.col(array_col))))
    df = stage(df) if stage_input else df
    arrays = (df.filter(F.size(array_col) > 0).groupBy("_af_key")
              .agg(F.any_value(array_col).alias("_af_array")))
    idx = dimension_index(dim, [label], pk, keep).select(
        F.col(label).alias("_af_label"), F.col(pk).alias("_af_pk"))
    ex = arrays.select("_af_key", F.posexplode("_af_array").alias("_af_pos", "_af_val"))
    j = ex.join(idx, ex["_af_val"] == idx["_af_label"], "left")
    grouped = j.groupBy("_af_key").agg(F.array_sort(F.collect_list(F.struct("_af_pos", "_af_pk"))).alias("_af_list"))
    grouped = grouped.select("_af_key", F.transform("_af_list", lambda x: x["_af_pk"]).alias(as_name))
    out = df.join(grouped, "_af_key", "left").drop("_af_key")
    return out.withColumn(as_name, F.coalesce(as_name, F.array().cast(out.schema[as_name].dataType)))


def unique_by(dim: DataFrame, keys, value_cols) -> DataFrame:
    """Per key, the value(s) when the key has exactly one distinct value
    combination; keys with several are dropped (the exactly-one rule)."""
    keys = list(keys)
    value_cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    v = F.struct(*value_cols)
    g = dim.groupBy(*keys).agg(F.count_distinct(v).alias("_ub_n"), F.min(v).alias("_ub_v"))
    return g.filter(F.col("_ub_n") == 1).select(*keys, "_ub_v.*")


def _as_number(df: DataFrame, name: str):
    """A point in time (or an integer) as a long."""
    kind = df.schema[name].dataType.typeName()
    if kind == "date":
        return F.unix_date(name).cast("bigint")
    return F.unix_micros(F.col(name).cast("timestamp")) if kind.startswith("timestamp") else F.col(name).cast("bigint")


def interval_candidates(probes: DataFrame, authority: DataFrame, pairs, point: str, start: str, end: str,
                        values) -> DataFrame:
    """Every probe with every interval of its key that holds its point.

    An interval of up to 2^k units lies in at most two bins of that width, and
    a point in one, so the join is on key, width and bin: a key with many
    intervals and many points gives about as many candidates as matches
    (at least a quarter of the points of a bin's neighbourhood match).  Widths
    are powers of two, at most 64, collected from the intervals.
    """
    low, high = _as_number(authority, start), _as_number(authority, end)
    a = authority.select(*[F.col(r).alias(f"_il_r{i}") for i, (_, r) in enumerate(pairs)],
                         low.alias("_il_s"), high.alias("_il_e"),
                         *[F.col(v).alias(f"_il_v{i}") for i, v in enumerate(values)])
    level = F.length(F.bin(F.col("_il_e") - F.col("_il_s")))  # 2^level exceeds the length
    a = a.filter(F.col("_il_s") <= F.col("_il_e")).withColumn("_il_level", level)
    widths = [r[0] for r in a.select("_il_level").distinct().collect()]
    a = a.withColumn("_il_bin", F.explode(F.sequence(*[F.expr(f"shiftright({c}, _il_level)") for c in ("_il_s", "_il_e")])))
    p = probes.withColumn("_il_p", _as_number(probes, point))
    p = p.withColumn("_il_at", F.explode(F.array(*[
        F.struct(F.lit(w).alias("level"), F.shiftright("_il_p", w).alias("bin")) for w in widths])
        if widths else F.array().cast("array<struct<level:int,bin:bigint>>")))
    cond = reduce(lambda x, y: x & y, [p[l] == a[f"_il_r{i}"] for i, (l, _) in enumerate(pairs)]
                  + [p["_il_at.level"] == a["_il_level"], p["_il_at.bin"] == a["_il_bin"],
                     p["_il_p"] >= a["_il_s"], p["_il_p"] <= a["_il_e"]])
    return p.join(a, cond, "inner")


def interval_lookup(df: DataFrame, authority: DataFrame, on, point: str,
                    start: str, end: str, values, prefix: str = "") -> DataFrame:
    """Equality on ``on`` plus ``start <= point <= end`` (inclusive); accepted
    only when exactly one authority row matches, else NULL values.

    Matching runs on the distinct (key, point) combinations, not on every
    fact row, so a million articles of one issue cost one probe; see
    ``interval_candidates`` for how they meet.
    """
    pairs = _pairs(on)
    values = [values] if isinstance(values, str) else list(values)
    lkeys = [l for l, _ in pairs] + [point]
    cand = interval_candidates(df.select(*lkeys).distinct(), authority, pairs, point, start, end, values)
    agg = cand.groupBy(*lkeys).agg(
        F.count(F.lit(1)).alias("_il_n"),
        *[F.min(f"_il_v{i}").alias(f"{prefix}{v}") for i, v in enumerate(values)])
    agg = agg.filter(F.col("_il_n") == 1).drop("_il_n")
    return df.join(agg, lkeys, "left")


def sole_interval(points: DataFrame, authority: DataFrame, keys, point: str, start: str, end: str,
                  values) -> DataFrame:
    """``(keys…, point, values…)`` of the distinct dates that exactly one interval of their keys holds (inclusive).

    A sweep instead of a join: an interval adds its row number where it starts
    and takes it out the day after its end, so a running count and a running
    xor over the dates of a key tell how many intervals hold a date and, if it
    is one, which.  However many hold it, a date is one row, and a key has no
    more rows than there are dates.
    """
    keys = list(keys)
    # staged, so that row numbers stay what they are
    rows = stage(authority.filter(F.col(start) <= F.col(end)).dropna(subset=keys).select(
        *keys, F.col(start).alias("_si_start"), F.col(end).alias("_si_end"), *values,
        F.monotonically_increasing_id().alias("_si_row")))
    edge = lambda at, n: F.struct(at.alias("_si_at"), F.lit(n).alias("_si_n"), F.col("_si_row").alias("_si_in"))
    edges = rows.select(*keys, F.inline(F.array(edge(F.col("_si_start"), 1), edge(F.date_add("_si_end", 1), -1))),
                        F.lit(False).alias("_si_asked"))
    asked = points.filter(F.col(point).isNotNull()).select(
        *keys, F.col(point).alias("_si_at"), F.lit(0), F.lit(0).cast("bigint"), F.lit(True))
    days = edges.union(asked).groupBy(*keys, "_si_at").agg(
        F.sum("_si_n").alias("_si_n"), F.bit_xor("_si_in").alias("_si_in"), F.bool_or("_si_asked").alias("_si_asked"))
    so_far = Window.partitionBy(*keys).orderBy("_si_at").rowsBetween(Window.unboundedPreceding, 0)
    held = days.select(*keys, F.col("_si_at").alias(point), "_si_asked", F.sum("_si_n").over(so_far).alias("_si_n"),
                       F.bit_xor("_si_in").over(so_far).alias("_si_row"))
    held = held.filter(F.col("_si_asked") & (F.col("_si_n") == 1))
    return held.join(rows.select("_si_row", *values), "_si_row").select(*keys, point, *values)


def lookup_first(df: DataFrame, dim: DataFrame, on, order_by, values, prefix: str = "") -> DataFrame:
    """Left lookup keeping the first dimension row (in ``order_by``) per key."""
    pairs = _pairs(on)
    values = [values] if isinstance(values, str) else list(values)
    rkeys = [r for _, r in pairs]
    first = keep_first(dim.select(*rkeys, *values, *[o for o in order_by if isinstance(o, str) and o not in values + rkeys]),
                       rkeys, order_by)
    first = first.select(*[F.col(r).alias(f"_lf_r{i}") for i, r in enumerate(rkeys)],
                         *[F.col(v).alias(f"{prefix}{v}") for v in values])
    cond = reduce(lambda a, b: a & b, [df[l] == first[f"_lf_r{i}"] for i, (l, _) in enumerate(pairs)])
    return df.join(first, cond, "left").drop(*[f"_lf_r{i}" for i in range(len(pairs))])


def cascade(df: DataFrame, tiers, out: str, tier_col: str = "match_tier") -> DataFrame:
    """Prioritised match: ``tiers`` is a list of ``(name, dim, on, value_col)``
    where each dim is already unique on its key (see ``unique_by``).  The
    first tier that yields a non-NULL value wins; ``tier_col`` records which.
    One left join per tier, no row loop."""
    cur = df
    cols = []
    for i, (name, dim, on, value) in enumerate(tiers):
        pairs = _pairs(on)
        d = dim.select(*[F.col(r).alias(f"_cc{i}_r{j}") for j, (_, r) in enumerate(pairs)],
                       F.col(value).alias(f"_cc{i}_v"))
        cond = reduce(lambda a, b: a & b,
                      [as_col(l) == d[f"_cc{i}_r{j}"] for j, (l, _) in enumerate(pairs)])
        cur = cur.join(d, cond, "left").drop(*[f"_cc{i}_r{j}" for j in range(len(pairs))])
        cols.append((name, F.col(f"_cc{i}_v")))
    value = F.coalesce(*[c for _, c in cols])
    tier = None
    for name, c in cols:
        tier = F.when(c.isNotNull(), F.lit(name)) if tier is None else tier.when(c.isNotNull(), F.lit(name))
    return cur.withColumns({out: value, tier_col: tier}).drop(*[f"_cc{i}_v" for i in range(len(tiers))])


def enrich(df: DataFrame, lookups, on: str) -> DataFrame:
    """Chain of left joins on one key; each lookup is ``(dim, columns)``.
    Each dim is reduced to one row per key first (first by the columns)."""
    cur = df
    for dim, cols in lookups:
        cols = list(cols)
        d = keep_first(dim.select(on, *cols), [on], cols)
        cur = cur.join(d, on, "left")
    return cur


def snowflake_split(df: DataFrame, attrs, pk: str, fk_name: str, drop: bool = True):
    """Split attribute columns into a dimension with a dense key and join the
    key back.  Returns ``(fact_with_fk, dimension)``.  Rows whose attributes
    are NULL or blank get no dimension row and a NULL FK."""
    from relnorm.operators.keys import dense_key
    from relnorm.functions.predicates import not_blank
    attrs = list(attrs)
    dim = df.select(*attrs).filter(not_blank(*attrs)).distinct()
    dim = dense_key(dim, attrs, pk=pk)
    d = dim.select(*[F.col(a).alias(f"_sf_{a}") for a in attrs], F.col(pk).alias(fk_name))
    cond = reduce(lambda a, b: a & b, [df[a] == d[f"_sf_{a}"] for a in attrs])
    fact = df.join(d, cond, "left").drop(*[f"_sf_{a}" for a in attrs])
    if drop:
        fact = fact.drop(*attrs)
    return fact, dim
