"""Pairs of demand and supply: predicates that let the unknown pass, cascades and their indexes.

A predicate takes columns and gives a boolean that is never null."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import numbered

#: Bounds of a side that is broadcast, in rows and in bytes of its rows as JSON.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
#: Pairs that a task of a product makes, about, and rows of each side of a block of two large sides.
TASK_PAIRS, CELL_ROWS = 20_000_000, 20_000
#: Rows of each side of a tile: pages of column files have 20,000 rows, and should hold a tile's supplies many times.
TILE = 256
#: Tasks of a product, at most.
TASKS = 10_000
#: Blocks of a supply in a range join: what a zone map has entries for.
BLOCKS = 128


def _either_null(*values: Column) -> Column:
    return reduce(lambda a, b: a | b, [v.isNull() for v in values])


def budget(demand: Column, supply: Column, margin: int = 120_000) -> Column:
    return _either_null(demand, supply) | F.coalesce(demand >= supply + margin, F.lit(False))


def age(most: Column, own: Column, unknown: int = 1) -> Column:
    return _either_null(most, own) | F.coalesce((own == unknown) | (own <= most), F.lit(False))


#: What a demand's way of work accepts of a supply's.
REMOTE = {"onsite": ("onsite", "hybrid", "fullremote"), "hybrid": ("hybrid", "fullremote"), "fullremote": ("hybrid", "fullremote")}


def compatible(demand: Column, supply: Column, accepts: Mapping[str, Sequence[str]]) -> Column:
    """A table of what each demand accepts; a demand that isn't in it accepts all."""
    met = reduce(lambda a, b: a | b, [(demand == k) & supply.isin(*v) for k, v in accepts.items()])
    return _either_null(demand, supply) | ~demand.isin(*accepts) | F.coalesce(met, F.lit(False))


def allowed(ok: Column, kind: Column, plain: str) -> Column:
    """Everybody where ``ok``, else only those of the ``plain`` kind."""
    return _either_null(ok, kind) | F.coalesce(ok | (kind == plain), F.lit(False))


def overlap(low: Column, high: Column, own_low: Column, own_high: Column) -> Column:
    return _either_null(low, high, own_low, own_high) | F.coalesce((own_high >= low) & (own_low <= high), F.lit(False))


#: Codes of supply that each level of demand takes; level 0 takes all, and a level not listed none.
TIERS = {1: (10, 20), 2: (10, 11, 20, 21), 3: (10, 11, 12, 20, 21, 22)}


def tier(level: Column, code: Column, tiers: Mapping[int, Sequence[int]]) -> Column:
    met = reduce(lambda a, b: a | b, [(level == k) & code.isin(*v) for k, v in tiers.items()])
    return _either_null(level, code) | F.coalesce((level == 0) | met, F.lit(False))


def effective(skills: Column, primary: Column | None = None, excluded: Sequence[str] = ()) -> Column:
    """What has to be shared: primary skills if there are any, else all; without excluded ones."""
    clean = lambda x: F.array_distinct(F.filter(F.coalesce(x, F.array().cast("array<string>")), lambda s: ~s.isin(*excluded) if excluded else F.lit(True)))
    if primary is None:
        return clean(skills)
    return F.when(F.size(clean(primary)) > 0, clean(primary)).otherwise(clean(skills))


def skills(demand: Column, supply: Column, primary: Column | None = None, excluded: Sequence[str] = ()) -> Column:
    return F.arrays_overlap(effective(demand, primary, excluded), effective(supply, None, excluded))


def shared_skills(demand: Column, supply: Column, primary: Column | None = None, excluded: Sequence[str] = ()) -> Column:
    """(met, matched, wanted, offered) of the same: the shared skills in the demand's order, and what was compared."""
    wanted, offered = effective(demand, primary, excluded), effective(supply, None, excluded)
    matched = F.array_intersect(wanted, offered)
    return F.struct((F.size(matched) > 0).alias("met"), matched.alias("matched"), wanted.alias("wanted"), offered.alias("offered"))


def phases(demand: Column, supply: Column, strong: Sequence[str]) -> Column:
    """An empty list passes; else a strong phase has to be shared."""
    empty = lambda x: x.isNull() | (F.size(x) == 0)
    only = lambda x: F.filter(x, lambda p: p.isin(*strong))
    return empty(demand) | empty(supply) | F.coalesce(F.arrays_overlap(only(demand), only(supply)), F.lit(False))


def seen_phases(own: Column, strong: Sequence[str]) -> Column:
    """What ``phases`` looks at, in few values: strong phases in order, and "" for all others."""
    return F.array_sort(F.array_distinct(F.transform(own, lambda p: F.when(p.isin(*strong), p).otherwise(""))))


def location(demand: Column, supply: Column, remote: Column, anywhere: str = "fullremote") -> Column:
    empty = lambda x: x.isNull() | (x == "")
    return F.coalesce(remote == anywhere, F.lit(False)) | empty(demand) | empty(supply) | F.coalesce(demand == supply, F.lit(False))


#: Contracts that pass on the demand's side alone.
CONTRACTS = ("quasi_mandate", "outsourcing")


def contract(kind: Column, passing: Sequence[str] = CONTRACTS) -> Column:
    return F.coalesce(kind.isin(*passing), F.lit(False))


def small(df: DataFrame) -> bool:
    """Whether ``df`` is within the bounds of a broadcast, by its first rows up to the bound."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    found = df.limit(BROADCAST_ROWS + 1).agg(F.count("*").alias("n"), size.alias("size")).first()
    return found["n"] <= BROADCAST_ROWS and (found["size"] or 0) <= BROADCAST_BYTES


def product(demand: DataFrame, supply: DataFrame, condition: Column | None = None) -> DataFrame:
    """All pairs, those of ``condition`` only. A side that is ``small`` in rows and bytes is
    broadcast, and the other one spread over tasks of about TASK_PAIRS pairs, however few files it comes in. Of two larger ones
    the supply is dealt to blocks of about CELL_ROWS rows and the demand to as large ones, each row
    visits all blocks of the other side, and both meet by the two numbers: one join,
    however many blocks there are. Columns of these two can't be maps. What it costs is the number of pairs: ``ranged``
    and ``sharing`` are for predicates that rule out most, ``by_values`` for those that look at few values, ``partners`` and
    ``pair_counts`` for where only numbers of pairs are wanted."""
    met = F.lit(True) if condition is None else condition
    if small(supply):
        return _tasks(demand, demand.count() * supply.count()).join(F.broadcast(supply), met, "inner")
    if small(demand):
        return F.broadcast(demand).join(_tasks(supply, demand.count() * supply.count()), met, "inner")
    blocks, salts = supply.count() // CELL_ROWS + 1, demand.count() // CELL_ROWS + 1
    tasks = min(blocks * salts, TASKS)  # told, as blocks are few bytes for the pairs they give, and would be put together
    left = _dealt(demand, "_salt", salts, "_block", blocks).repartition(tasks, "_block", "_salt")
    right = _dealt(supply, "_block", blocks, "_salt", salts).repartition(tasks, "_block", "_salt")
    both = left.join(right, ["_block", "_salt"])
    return (both if condition is None else both.filter(condition)).drop("_block", "_salt")


def _tasks(df: DataFrame, made: int) -> DataFrame:
    """``df`` over as many tasks as ``made`` pairs take; as it is where one does."""
    tasks = min(made // TASK_PAIRS + 1, TASKS)
    return df.repartition(tasks) if tasks > 1 else df


#: How a demand's value has to stand to a supply's, and which of a block's values is the easiest to meet.
_HOLDS = {">=": (lambda d, s: d >= s, F.min), "<=": (lambda d, s: d <= s, F.max)}


def ranged(demand: DataFrame, supply: DataFrame, bounds: Sequence[tuple[str, str, str]], blocks: int = BLOCKS) -> DataFrame:
    """Pairs for which all ``bounds`` hold, such as ("price", ">=", "wanted"): a column of the demand, ">=" or
    "<=", a column of the supply. A pair with a null in any of these columns passes.

    An equi-join: the supply is cut into blocks along its first column, the least and greatest values of each
    block come to the driver (``blocks`` rows), and a demand is sent only to the blocks that may have a partner
    for it. Supplies with a null are a block that all visit. Blocks beyond BROADCAST_ROWS rows, as of a frequent
    value, are dealt to several tasks, and so are demands; columns can't be maps then."""
    if not bounds or any(op not in _HOLDS for _, op, _ in bounds):
        raise ValueError("bounds are (demand's column, '>=' or '<=', supply's column)")
    wanted, own = [F.col(a) for a, _, _ in bounds], [F.col(c) for _, _, c in bounds]
    unknown = lambda values: _either_null(*values)
    kind = supply.schema[bounds[0][2]].dataType
    cuts = supply.agg(F.percentile_approx(own[0], [i / blocks for i in range(1, blocks)], 10_000)).first()[0] or []
    cuts = F.array(*[F.lit(x).cast(kind) for x in sorted(set(cuts))]) if cuts else F.array().cast(f"array<{kind.simpleString()}>")
    number = F.when(unknown(own), F.lit(-1)).otherwise(F.size(F.filter(cuts, lambda x: x < own[0])))
    broadcast = small(supply)
    salts = 1 if broadcast else demand.count() // BROADCAST_ROWS + 1
    held = supply.withColumn("_block", number)
    ends = [_HOLDS[op][1](c).alias(f"e{i}") for i, ((_, op, _), c) in enumerate(zip(bounds, own, strict=True))]
    zones = held.groupBy("_block").agg(F.count("*").alias("n"), *ends).collect()
    if not zones:
        return demand.limit(0).join(supply, F.lit(True), "inner")
    parts = lambda n: 1 if broadcast else n // BROADCAST_ROWS + 1
    zone = lambda z: F.struct(
        F.lit(z["_block"]).alias("block"), F.lit(parts(z["n"])).alias("parts"),
        *[F.lit(z[f"e{i}"]).cast(supply.schema[c].dataType).alias(f"e{i}") for i, (_, _, c) in enumerate(bounds)],
    )
    may = lambda z: reduce(lambda a, b: a & b, [_HOLDS[op][0](d, z[f"e{i}"]) for i, ((_, op, _), d) in enumerate(zip(bounds, wanted, strict=True))])
    visited = F.filter(F.array(*map(zone, zones)), lambda z: (z["block"] == -1) | unknown(wanted) | F.coalesce(may(z), F.lit(False)))
    places = F.flatten(F.transform(visited, lambda z: F.transform(F.sequence(F.lit(0), z["parts"] - 1), lambda p: F.struct(z["block"].alias("block"), p.alias("part")))))
    holds = reduce(lambda a, b: a & b, [_HOLDS[op][0](F.col(d), F.col(s)) for d, op, s in bounds])
    met = unknown([*wanted, *own]) | F.coalesce(holds, F.lit(False))
    if broadcast:
        left = demand.withColumn("_at", F.explode(places)).withColumn("_place", F.col("_at.block")).drop("_at")
        both = left.join(F.broadcast(held.withColumnRenamed("_block", "_own")), (F.col("_place") == F.col("_own")) & met)
        return both.drop("_place", "_own")
    left = _dealt(demand, "_salt", salts).withColumn("_at", F.explode(places)).select("*", F.col("_at.block").alias("_place"), F.col("_at.part").alias("_part")).drop("_at")
    most = max(parts(z["n"]) for z in zones)
    sizes = F.create_map(*[F.lit(x) for z in zones for x in (z["_block"], parts(z["n"]))])
    right = _dealt(held, "_hash", most * 4096, "_salt", salts).withColumn("_own_part", F.pmod("_hash", F.element_at(sizes, F.col("_block")))).drop("_hash")
    right = right.withColumnsRenamed({"_block": "_own", "_salt": "_own_salt"})
    same = (F.col("_place") == F.col("_own")) & (F.col("_part") == F.col("_own_part")) & (F.col("_salt") == F.col("_own_salt"))
    return left.join(right, same & met).drop("_place", "_part", "_salt", "_own", "_own_part", "_own_salt")


def range_counts(demand: DataFrame, supply: DataFrame, bound: tuple[str, str, str], left: Sequence[str] = (), right: Sequence[str] = (), blocks: int = BLOCKS) -> DataFrame:
    """Numbers of pairs by columns ``left`` of the demand and ``right`` of the supply, other names than each other's: ``n_met`` that
    meet one bound, as those of ``ranged``, and ``n_all``. No pair is made: equal rows are one with a number, both sides are cut along
    the values, of blocks that lie before a demand's only the numbers are met, and those of its own block are
    running sums, for each set of values of ``right``: they should be few, other than those of ``left``."""
    value, op, own = bound
    if op not in _HOLDS:
        raise ValueError("a bound is (demand's column, '>=' or '<=', supply's column)")
    a = demand.groupBy(*left, F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    b = supply.groupBy(*right, F.col(own).alias("_value")).agg(F.count("*").alias("_m"))
    ends = a.select("_value").union(b.select("_value"))
    kind = ends.schema["_value"].dataType
    cuts = ends.agg(F.percentile_approx("_value", [i / blocks for i in range(1, blocks)], 10_000)).first()[0] or []
    cuts = F.array(*[F.lit(x).cast(kind) for x in sorted(set(cuts))]) if cuts else F.array().cast(f"array<{kind.simpleString()}>")
    at = F.col("_value").cast(kind)
    before = (lambda x: x < at) if op == ">=" else (lambda x: x > at)
    number = F.when(at.isNull(), F.lit(-1)).otherwise(F.size(F.filter(cuts, before)))
    a, b = (df.withColumn("_value", at).withColumn("_block", number) for df in (a, b))
    # whole blocks: a null meets all, a value all blocks behind its own; -2 is for all pairs
    reach = F.when(F.col("_block") == -1, F.sequence(F.lit(-2), F.lit(blocks))).otherwise(
        F.concat(F.array(F.lit(-2), F.lit(-1)), F.sequence(F.col("_block") + 1, F.lit(blocks)))
    )
    reached = b.groupBy(*right, "_block").agg(F.sum("_m").alias("_m")).select(*right, "_m", F.explode(reach).alias("_block")).groupBy(*right, "_block").agg(F.sum("_m").alias("_m"))
    placed = a.groupBy(*left, "_block").agg(F.sum("_n").alias("_n")).select(*left, "_n", F.explode(F.array("_block", F.lit(-2))).alias("_block"))
    total, whole = F.col("_n") * F.col("_m"), F.col("_block") == -2
    far = placed.join(reached, "_block").select(*left, *right, F.when(whole, 0).otherwise(total).alias("n_met"), F.when(whole, total).otherwise(0).alias("n_all"))
    # its own block: sums along the values, equal ones included
    points = b.filter("_block >= 0").select(*right, "_block", "_value", "_m", *[F.lit(None).cast(a.schema[x].dataType).alias(x) for x in left], F.lit(0).cast("long").alias("_n"))
    probes = a.filter("_block >= 0").join(b.select("_block", *right).distinct(), "_block").select(*right, "_block", "_value", F.lit(0).cast("long").alias("_m"), *left, "_n")
    along = Window.partitionBy("_block", *right).orderBy(F.col("_value") if op == ">=" else F.desc("_value")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = probes.union(points).withColumn("_m", F.sum("_m").over(along)).filter("_n > 0").select(*left, *right, total.alias("n_met"), F.lit(0).cast("long").alias("n_all"))
    return near.union(far).groupBy(*left, *right).agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("n_met", "n_all")])


def by_values(demand: DataFrame, supply: DataFrame, left: Sequence[str], right: Sequence[str], condition: Column, rest: Column | None = None, along: tuple[Sequence[str], Sequence[str]] = ((), ())) -> DataFrame:
    """Pairs for which a ``condition`` on the columns ``left`` and ``right`` holds, decided once for each two distinct sets of
    values: these are paired, and both sides joined to the pairs that hold. Nulls are values. ``rest`` is what has to hold
    besides, on any columns: it is tried on these pairs only.

    Rows come in tiles: up to TILE rows of each side, which are next to each other ``along`` columns of the demand and of the supply,
    and in a tile each demand meets the same supplies in the same order. So files of columns take a few bits a pair, where pairs in
    any order take some bytes. A task has cells of tiles, of at most about TASK_PAIRS pairs: large ones are mostly alone in it; a row is copied for as many cells as it is in."""
    side = math.isqrt(TASK_PAIRS)
    tile = min(TILE, side)
    cell = side // tile * tile
    a, b = _tiles(demand, left, along[0], "_left", "_demand", tile), _tiles(supply, right, along[1], "_right", "_supply", tile)
    cells = lambda n: F.floor((F.col(n) - 1) / cell).cast("int")  # noqa: E731  the last one's number
    kinds = product(grouped(demand.select(*left), "_n").filter("_n > 0"), grouped(supply.select(*right), "_m").filter("_m > 0"), condition)
    kinds = kinds.select(_values(left).alias("_left"), _values(right).alias("_right"), cells("_n").alias("_last"), cells("_m").alias("_own_last"), (F.col("_n") * F.col("_m")).alias("_pairs"))
    made = kinds.agg(F.sum("_pairs")).first()[0] or 0
    tasks, at = min(made * 4 // TASK_PAIRS + 2, TASKS), F.coalesce(F.floor(F.col("_tile") * tile / cell).cast("int"), F.lit(0))
    every = lambda last: F.explode(F.sequence(F.lit(0), F.col(last)))
    # one column is the key, of one type on both sides: of several, one that is a constant is left out of the join, which then deals the rows anew
    placed = lambda df: df.select(F.struct("_left", "_cell", "_right", "_own_cell").alias("_place"), df.columns[-1]).repartition(tasks, "_place")
    wanted = placed(a.join(kinds, "_left").select("_left", at.alias("_cell"), "_right", every("_own_last").alias("_own_cell"), "_demand"))
    offered = placed(b.join(kinds, "_right").select("_left", every("_last").alias("_cell"), "_right", at.alias("_own_cell"), "_supply"))
    both = wanted.join(offered.withColumn("_supply", _sorted("_supply")), "_place")
    # a function with a lambda is not compiled, so demands come one by one from here: compiled, all pairs of a tile would be held
    both = both.withColumn("_demand", F.explode(_sorted("_demand"))).withColumn("_supply", F.explode("_supply"))
    of = lambda df, by, key, row: [F.col(f"_place.{key}.`{c}`" if c in by else f"{row}.`{c}`").alias(c) for c in df.columns]
    pairs = both.select(*of(demand, left, "_left", "_demand"), *of(supply, right, "_right", "_supply"))
    return pairs if rest is None else pairs.filter(rest)


def _values(columns: Sequence[str]) -> Column:
    """A key of these columns' values, also of none."""
    return F.struct(F.lit(True).alias("_"), *[F.col(c) for c in columns])


def _tiles(df: DataFrame, by: Sequence[str], along: Sequence[str], key: str, name: str, size: int) -> DataFrame:
    """(key, tile, rows): the rows of each set of values of ``by``, with their places ``along`` columns, in arrays of up to ``size`` next to each other."""
    placed = numbered(df.withColumn(key, _values(by)), [key], [F.col(c) for c in along], "_at")
    row = F.struct("_at", *[F.col(c) for c in df.columns if c not in by])
    return placed.groupBy(key, F.floor((F.col("_at") - 1) / size).alias("_tile")).agg(F.collect_list(row).alias(name))


def _sorted(rows: str) -> Column:
    return F.array_sort(rows, lambda x, y: (x["_at"] - y["_at"]).cast("int"))


def pair_counts(demand: DataFrame, supply: DataFrame, condition: Column, by: Sequence[str], name: str = "n", bounds: Sequence[tuple[str, str, str]] | None = None) -> DataFrame:
    """How many pairs meet ``condition``, by columns of either side: equal rows of each side are one row with a
    number, so what is paired are the distinct ones. ``bounds``: as for ``ranged``, which then finds the pairs."""
    a, b = grouped(demand, "_n"), grouped(supply, "_m")
    both = product(a, b, condition) if bounds is None else ranged(a, b, bounds).filter(condition)
    return both.groupBy(*by).agg(F.sum(F.col("_n") * F.col("_m")).alias(name))


def partners(demand: DataFrame, supply: DataFrame, left: Sequence[str], right: Sequence[str], condition: Column, name: str = "n") -> DataFrame:
    """The demands that have partners, with their number. The ``condition`` looks at the columns ``left`` and ``right`` only, so
    partners are counted for each distinct set of values of ``left``, and no pair of rows is made. Nulls are values."""
    counts = pair_counts(demand.select(*left).distinct(), supply.select(*right), condition, left, name)
    kinds = counts.select(F.struct(*left).alias("_left"), name)
    return demand.withColumn("_left", F.struct(*left)).join(kinds, "_left").drop("_left")


def _dealt(df: DataFrame, own: str, parts: int, every: str | None = None, others: int = 1) -> DataFrame:
    """Each row in one of ``parts`` and in all of ``others``. Equal rows are numbered, so that they are
    spread, and a task that runs again deals the same."""
    numbered = df.groupBy(*df.columns).agg(F.count("*").alias("_n")).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    dealt = numbered.select(*df.columns, F.pmod(F.xxhash64(*df.columns, "_copy"), F.lit(parts)).cast("int").alias(own))
    return dealt if every is None else dealt.withColumn(every, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def grouped(df: DataFrame, count: str) -> DataFrame:
    """Distinct rows with their number: a side of a product whose predicate looks at few values."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(count))


def cascade(df: DataFrame, stages: Sequence[tuple[str, Column]], audit: bool = False) -> DataFrame:
    """The rows that pass all stages; with ``audit`` all rows, with the first stage that failed (null: none)."""
    if not audit:
        return df.filter(reduce(lambda a, b: a & b, [c for _, c in stages]))
    return df.withColumn("first_failed", F.coalesce(*[F.when(~c, F.lit(n)) for n, c in stages], F.lit(None).cast("string")))


def _sets(df: DataFrame, side: tuple[str, Column], to: str) -> DataFrame:
    return df.select(F.col(side[0]).alias(to), F.array_sort(F.array_distinct(side[1])).alias("items")).filter(F.size("items") > 0).distinct()


def _meeting(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two distinct sets (a, b) with an item in common, each pair once: that of its least common item."""
    own = lambda df, to: df.select(F.col("items").alias(to)).distinct().withColumn("item", F.explode(to))
    return own(a, "a").join(own(b, "b"), "item").filter(F.col("item") == F.array_min(F.array_intersect("a", "b"))).select("a", "b")


def sharing(demand: DataFrame, supply: DataFrame, left: tuple[str, Column], right: tuple[str, Column]) -> DataFrame:
    """Distinct (left, right) ids with an item in common, by a join on the items rather than over all
    pairs. Ids with one set of items are joined as one first, so that few items or equal sets cost
    pairs of sets; a pair of sets is found through each common item and kept for the least of them,
    so nothing has to be made distinct after the join. An id has one set."""
    a, b = _sets(demand, left, "left"), _sets(supply, right, "right")
    return _meeting(a, b).join(a.withColumnRenamed("items", "a"), "a").join(b.withColumnRenamed("items", "b"), "b").select("left", "right")


def sharing_counts(demand: DataFrame, supply: DataFrame, left: tuple[str, Column], right: tuple[str, Column], name: str = "n") -> DataFrame:
    """Of ``sharing`` each left id with its number of right ones. Ids are counted by their sets, and only sets are paired."""
    a, b = _sets(demand, left, "left"), _sets(supply, right, "right")
    met = _meeting(a, b).join(b.groupBy(F.col("items").alias("b")).agg(F.count("*").alias("_m")), "b").groupBy("a").agg(F.sum("_m").alias(name))
    return a.withColumnRenamed("items", "a").join(met, "a").select("left", name)


def keyword_hits(texts: DataFrame, key: str, text: str, keywords: Sequence[str]) -> DataFrame:
    """Each text's keywords, found once, whatever the number of its pairs (substrings, any case). The
    text is lower-cased once, in a column of its own; for some hundred keywords."""
    low = texts.select(key, F.explode(F.array(F.lower(F.coalesce(F.col(text), F.lit(""))))).alias("_low"))
    found = [F.when(F.contains("_low", F.lit(w.lower())), F.lit(w)) for w in sorted(set(keywords))]
    return low.select(key, F.array_compact(F.array(*found)).alias("hits"))


def containment(required: Column, strong: Column, sheet: Column, body: Column) -> Column:
    """(matched, hits, source, reason) of required keywords and strong phases against the keywords
    found in a sheet and in a mail: a strong phase has to be in the same text as a skill."""

    def judged(found: Column, source: str) -> Column:
        hits, phase = F.array_intersect(required, found), F.array_intersect(strong, found)
        ok = (F.size(hits) > 0) & ((F.size(strong) == 0) | (F.size(phase) > 0))
        reason = F.when(F.size(strong) > 0, "matched_required_skill_and_phase").otherwise("matched_required_skill_only")
        return F.when(ok, F.struct(F.lit(True).alias("matched"), F.array_union(hits, phase).alias("hits"), F.lit(source).alias("source"), reason.alias("reason")))

    none = lambda reason, hits: F.struct(F.lit(False).alias("matched"), hits.alias("hits"), F.lit("none").alias("source"), F.lit(reason).alias("reason"))
    a, b = F.array_intersect(required, sheet), F.array_intersect(required, body)
    most = F.when(F.size(a) >= F.size(b), a).otherwise(b)
    return F.when(F.size(required) == 0, none("rejected_no_required_conditions", F.array().cast("array<string>"))).otherwise(
        F.coalesce(judged(sheet, "sheet"), judged(body, "body"), none("not_matched", most))
    )


def without_noise(hits: Column, checks: Sequence[tuple[str, str, Column]], unconditional: Sequence[str] = ()) -> Column:
    """(kept, removed, reasons): unconditional terms go, and each checked term unless its condition
    holds. ``checks``: (term, reason, condition)."""
    why = lambda h: F.coalesce(
        F.when(h.isin(*unconditional) if unconditional else F.lit(False), F.lit("unconditional")),
        *[F.when((h == term) & ~F.coalesce(ok, F.lit(False)), F.lit(reason)) for term, reason, ok in checks],
        F.lit(None).cast("string"),
    )
    removed = F.filter(hits, lambda h: why(h).isNotNull())
    return F.struct(F.filter(hits, lambda h: why(h).isNull()).alias("kept"), removed.alias("removed"), F.transform(removed, why).alias("reasons"))
