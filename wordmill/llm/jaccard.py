"""N-gram Jaccard join in a metric space: pivots, Voronoi regions, triangle windows, recursion.

Documents are sets of word shingles; one minus the Jaccard similarity is a metric. The join
finds all pairs within radius r and gives the components that they link.

1. Equal sets are one point. Points carry a 64-bit id made from all their shingles.
2. The first pivots are single shingles. In a fixed order of all shingles, the home region of a
   point is the one of its first shingle. A point at distance r at most shares all but the
   fraction r of the shingles, so its home lies within the first r * n + 1 shingles of this
   point: into these regions a point of n shingles is replicated, and pairs meet in the region
   of their first common shingle. Shingles of hot passages are put last in the order, so that
   no region is made by what very many unrelated documents share.
3. Regions of several points take some of their points as pivots. Distances to pivots are exact.
   Points within r of a pivot are linked by it, and all links so far give components. Only pairs
   of different components are still looked for. With m the least distance to pivot p among the
   points of other components, a point y within r of p can be near any of those only if
   d(y, p) >= m - r (triangle inequality): this window, and the points near no pivot, make the
   next region, which is joined in the same way until no region has two components left. Sizes
   are distances to the empty set, and sketches of the sets lie in a metric space onto which sets
   are mapped without growth of distances; both bound a pair before its sets are read.

So groups of copies make stars about pivots, not all pairs, and no link between components is
lost: two points of one region within r are of one component, or meet again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import (
    IS_SPACE,
    Batches,
    fused,
    joined_bytes,
    lowered,
    mixed,
    pieces,
    prefix_hash,
    run_hash,
    scratch,
    span_hash,
    words,
    written,
)
from wordmill.llm.links import components

SHINGLE = 5
#: Similarity of linked documents, in hundredths.
PERCENT = 80
#: Buckets of the count of shingles that finds hot ones (fixed size: 8 MB in a task). More
#: buckets tell shingles of medium frequency apart in a larger corpus.
BUCKET_BITS = 22
BUCKETS = 1 << BUCKET_BITS
_PART = 1 << 12
#: Bits of the filter that names the points of shared regions (fixed size: 4 MB).
FILTER_BITS = 1 << 25
#: Pivots of a region in the first round; each round takes four times as many.
PIVOTS = 2
#: Rounds whose pivots are of the largest component of a region.
WIDE = 3
#: Bytes of text that a task hashes at a time; arrays take some fifty times as much.
PIECE = 1 << 20
#: Shingles that a task counts at a time.
COUNTED = 1 << 20
#: A task does not emit a point again while its id is among this many.
SEEN = 500_000


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of every text; fewer words than a shingle are one, none is empty."""
    data, offsets = joined_bytes(texts)
    data = lowered(data)
    starts, ends, first = words(data, offsets, ~IS_SPACE)
    hashes = span_hash(prefix_hash(data), starts, ends)
    runs = run_hash(hashes, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            yield run_hash(hashes[a:b], b - a)
        else:
            yield np.zeros(0, dtype=np.uint64)


def point_id(own: np.ndarray) -> int:
    """The id of a set: a hash of all its members, as a signed 64-bit number."""
    total = np.array([np.add.reduce(mixed(own)) + np.uint64(len(own))], dtype=np.uint64)
    return int(mixed(total).view(np.int64)[0])


def _describing(id_column: str, text_column: str, size: int):
    def step(batches: Batches) -> Batches:
        for batch in pieces(batches, text_column, PIECE):
            sets = list(shingle_sets(batch.column(text_column), size))
            points = [point_id(x) if len(x) else None for x in sets]
            yield pa.record_batch(
                [batch.column(id_column), pa.array(points, pa.int64()), pa.array(map(len, sets), pa.int64())],
                names=[id_column, "point", "n_shingles"],
            )

    return step


def _counting(text_column: str, size: int):
    def step(batches: Batches) -> Batches:
        counts = np.zeros(BUCKETS, dtype=np.int32)
        held: list[np.ndarray] = []

        def add() -> None:
            found = np.concatenate([*held, np.zeros(0, np.uint64)])
            some, times = np.unique((found >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), return_counts=True)
            counts[some] += times
            held.clear()

        for batch in pieces(batches, text_column, PIECE):
            held += shingle_sets(batch.column(text_column), size)
            if sum(map(len, held)) >= COUNTED:
                add()
        add()
        parts = np.minimum(counts, 65535).astype(np.uint16).reshape(-1, _PART)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.record_batch(
            [pa.array(some, pa.int64()), pa.array([parts[k].tobytes() for k in some], pa.binary())],
            names=["part", "counts"],
        )

    return step


def _summing(batches: Batches) -> Batches:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            own = np.frombuffer(raw, dtype=np.uint16).astype(np.int64)
            total[part] = total[part] + own if part in total else own
    yield pa.record_batch(
        [pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
        names=["part", "counts"],
    )


def hot_buckets(docs: DataFrame, text_column: str, size: int) -> np.ndarray:
    """Marks of the buckets that hold far more shingles than the mean; counts cover all documents.

    Any marks give right results: they only set the order of the shingles.
    """
    parts = fused(docs, [text_column], [_counting(text_column, size)], "part long, counts binary")
    sums = fused(parts.repartition("part"), ["part", "counts"], [_summing], "part long, counts binary")
    counts = np.zeros((BUCKETS // _PART, _PART), dtype=np.int64)
    for row in sums.collect():
        counts[row["part"]] += np.frombuffer(row["counts"], dtype=np.int64)
    counts = counts.ravel()
    return counts > max(64.0, 2 * counts.mean())


def reach(n: int, percent: int) -> int:
    """Into so many first regions a set of n shingles goes: more would exceed the radius."""
    return n - -(-n * percent // 100) + 1


def _placing(hot: Broadcast, text_column: str, size: int, percent: int):
    def step(batches: Batches) -> Batches:
        marks = hot.value
        seen: set[int] = set()
        for batch in pieces(batches, text_column, PIECE):
            tokens, points, sizes, places = [], [], [], []
            for own in shingle_sets(batch.column(text_column), size):
                if not len(own):
                    continue
                point = point_id(own)
                if point in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(point)
                n = reach(len(own), percent)
                late = marks[(own >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                order = own[:n] if not late[:n].any() else np.concatenate([own[~late], own[late]])[:n]
                tokens.append(order)
                points.append(point)
                sizes.append(len(own))
                places.append(np.arange(n, dtype=np.int32))
            counts = [len(t) for t in tokens]
            yield pa.record_batch(
                [
                    pa.array(np.concatenate([*tokens, np.zeros(0, np.uint64)]).view(np.int64)),
                    pa.array(np.repeat(np.array(points, np.int64), counts)),
                    pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                    pa.array(np.concatenate([*places, np.zeros(0, np.int32)])),
                ],
                names=["region", "point", "n", "i"],
            )

    return step


def _of_row(points: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One number for a point and the key of the row that stands for it."""
    return (mixed(points.view(np.uint64).copy()) + keys.view(np.uint64)).view(np.int64)


def _bits(points: np.ndarray) -> np.ndarray:
    h = mixed(points.view(np.uint64).copy())
    return np.stack([(h >> np.uint64(s)) % np.uint64(FILTER_BITS) for s in (0, 13, 26, 39)]).astype(np.int64)


def _marked(packed: bytes, points: np.ndarray) -> np.ndarray:
    """Which points a filter holds; it stays packed."""
    places = _bits(points)
    marks = np.frombuffer(packed, np.uint8)[places >> 3] >> (7 - (places & 7)).astype(np.uint8)
    return (marks & 1).all(axis=0)


def _reading(wanted: Broadcast, size: int):
    """Step: the sets of the rows that stand for a wanted point (and a few more: it is a filter)."""

    def step(batches: Batches) -> Batches:
        for batch in pieces(batches, "_text", PIECE):
            sets = list(shingle_sets(batch.column("_text"), size))
            points = np.array([point_id(x) for x in sets], dtype=np.int64)
            rows = _of_row(points, batch.column("_key").to_numpy())
            take = [k for k in np.flatnonzero(_marked(wanted.value, rows)) if len(sets[k])]
            yield pa.record_batch(
                [
                    pa.array(points[take], pa.int64()),
                    pa.array([_sketch(sets[k]) for k in take], pa.binary()),
                    pa.array([sets[k].tobytes() for k in take], pa.binary()),
                ],
                names=["point", "sketch", "shingles"],
            )

    return step


def _sketch(own: np.ndarray) -> bytes:
    """How many shingles fall into each of 256 classes; 255 stands for any number from there on."""
    return np.minimum(np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def _bounding(percent: int):
    """Step: at most how many shingles a pair shares, class by class, and whether that is enough.

    Classes map sets to counts; no pair is further apart as counts than as sets, so what is
    too far by its sketches is too far.
    """

    def step(batches: Batches) -> Batches:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, 256) for c in ("x", "y")
            )
            n, m = batch.column("n").to_numpy().astype(np.int64), batch.column("m").to_numpy().astype(np.int64)
            most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            most = np.where((x == 255).any(axis=1) | (y == 255).any(axis=1), np.minimum(n, m), most)
            most = np.minimum(most, np.minimum(n, m))
            yield pa.record_batch(
                [
                    batch.column("a"),
                    batch.column("b"),
                    pa.array(most),
                    pa.array(n + m),
                    pa.array(100 * most >= percent * (n + m - most)),
                ],
                names=["a", "b", "common", "total", "maybe"],
            )

    return step


def _measuring(batches: Batches) -> Batches:
    """Step: exact overlap of the two sets of every pair."""
    for batch in batches:
        left, right = batch.column("x").to_pylist(), batch.column("y").to_pylist()
        both = []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both.append(len(x) + len(y) - len(np.unique(np.concatenate([x, y]))))
        yield pa.record_batch(
            [
                batch.column("a"),
                batch.column("b"),
                pa.array(both, pa.int64()),
                pa.array([(len(x) + len(y)) // 8 for x, y in zip(left, right, strict=True)], pa.int64()),
            ],
            names=["a", "b", "common", "total"],
        )


def _filter_of(points: DataFrame, spark) -> Broadcast:
    """A filter of fixed size that holds all given points (with their rows' keys, if any).

    The tasks make it in parts, which are united here.
    """

    def step(batches: Batches) -> Batches:
        marks = np.zeros(FILTER_BITS, dtype=bool)
        some = False
        for batch in batches:
            own = batch.column("point").to_numpy()
            if "_key" in batch.schema.names:
                own = _of_row(own, batch.column("_key").to_numpy())
            marks[_bits(own).ravel()] = True
            some = some or len(own) > 0
        if some:
            places = np.flatnonzero(marks.reshape(-1, 1 << 15).any(axis=1))
            parts = np.packbits(marks).reshape(-1, 1 << 12)
            yield pa.record_batch(
                [pa.array(places, pa.int64()), pa.array([parts[k].tobytes() for k in places], pa.binary())],
                names=["part", "marks"],
            )

    def unite(batches: Batches) -> Batches:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                own = np.frombuffer(raw, np.uint8)
                total[part] = total[part] | own if part in total else own
        yield pa.record_batch(
            [pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
            names=["part", "marks"],
        )

    made = fused(points, points.columns, [step], "part long, marks binary")
    out = np.zeros((FILTER_BITS >> 15, 1 << 12), dtype=np.uint8)
    for row in fused(made.repartition("part"), ["part", "marks"], [unite], "part long, marks binary").collect():
        out[row["part"]] |= np.frombuffer(row["marks"], np.uint8)
    return spark.sparkContext.broadcast(out.tobytes())


def _held(wanted: Broadcast):
    """Step: the rows whose point the filter holds."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.filter(pa.array(_marked(wanted.value, batch.column("point").to_numpy())))

    return step


def _near(percent: int):
    return F.expr(f"100 * common >= {percent} * (total - common)")


def _meeting(placed: DataFrame, percent: int) -> DataFrame:
    """The members of regions that can hold a pair, by what sizes and places alone tell.

    A pair within the radius that first meets at place i of a set of n shingles shares at most
    n - i of them. For every member the next smaller and the next larger one are looked at; the
    filter runs twice, since a member that goes may leave another one alone.
    """
    by_size = Window.partitionBy("region").orderBy("n", "point")
    # copies of a point that several tasks have placed stand together
    rows = placed.withColumn("_before", F.lag("point").over(by_size))
    rows = rows.where("_before IS NULL OR _before != point").drop("_before")
    for _ in range(2):
        rows = rows.withColumns({"_less": F.lag("n").over(by_size), "_more": F.lead("n").over(by_size)})
        rows = rows.where(
            f"100 * _less >= {percent} * n OR (100 * n >= {percent} * _more "
            f"AND {percent} * (n + _more) <= {100 + percent} * (n - i))"
        ).drop("_less", "_more")
    return rows


def linked_points(
    docs: DataFrame, about: DataFrame, id_column: str, text_column: str, size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(node, root) of all points that links connect; points without a link are left out."""
    spark = docs.sparkSession
    folder = scratch(spark)
    radius = 1 - percent / 100
    hot = spark.sparkContext.broadcast(hot_buckets(docs, text_column, size))
    schema = "region long, point long, n int, i int"
    placed = fused(docs, [text_column], [_placing(hot, text_column, size, percent)], schema)
    members = written(_meeting(placed, percent), f"{folder}/members")

    # one row stands for each point, so that sets are read once
    key = F.xxhash64(id_column)
    stands = about.where("point IS NOT NULL").groupBy("point").agg(F.min(key).alias("_key"))
    stands = stands.join(members.select("point").distinct(), "point")
    wanted = _filter_of(stands, spark)
    texts = docs.select(key.alias("_key"), F.col(text_column).alias("_text"))
    sets = fused(texts, ["_key", "_text"], [_reading(wanted, size)], "point long, sketch binary, shingles binary")
    sets = written(sets, f"{folder}/sets")

    # the original of a group of near copies shares most with the others: a pivot near to all
    central = written(members.groupBy("point").agg(F.count("*").alias("regions")), f"{folder}/central")
    members = members.withColumn("root", F.col("point"))
    known: DataFrame | None = None
    roots = spark.createDataFrame([], "node long, root long")
    turn = 0
    while members.take(1):
        pivots = PIVOTS * 4**turn
        # few pairs with points of the largest component link most others to it; then points of small
        # components come first, theirs are the pairs that links do not settle
        alike = Window.partitionBy("region", "root")
        by_component = F.desc("alike") if turn < WIDE else F.asc("alike")
        order = Window.partitionBy("region").orderBy(by_component, F.desc("regions"), "point")
        ranked = members.join(central, "point").repartition("region").withColumn("alike", F.count("*").over(alike))
        ranked = ranked.withColumn("is_pivot", F.row_number().over(order) <= pivots).drop("regions", "alike")
        ranked = written(ranked, f"{folder}/ranked{turn}")
        pairs = _with_pivots(ranked)
        fits = F.expr(
            f"100 * least(n, pn) >= {percent} * greatest(n, pn) "
            f"AND {percent} * (n + pn) <= {100 + percent} * least(n - i, pn - pi)"
        )
        new = pairs.where(fits).select(
            F.least("point", "pivot").alias("a"),
            F.greatest("point", "pivot").alias("b"),
            F.when(F.col("point") < F.col("pivot"), F.col("n")).otherwise(F.col("pn")).alias("n"),
            F.when(F.col("point") < F.col("pivot"), F.col("pn")).otherwise(F.col("n")).alias("m"),
        ).distinct()
        if known is not None:
            new = new.join(known.select("a", "b"), ["a", "b"], "left_anti")

        new = written(new, f"{folder}/new{turn}")
        own = sets
        if turn:
            # only the sets that are measured now are dealt
            points = new.select(F.col("a").alias("point")).unionAll(new.select(F.col("b").alias("point")))
            own = fused(sets, sets.columns, [_held(_filter_of(points, spark))], "point long, sketch binary, shingles binary")
            own = written(own, f"{folder}/sets{turn}")

        def sides(frame: DataFrame, column: str, own: DataFrame = own) -> DataFrame:
            frame = frame.join(own.select(F.col("point").alias("a"), F.col(column).alias("x")), "a")
            return frame.join(own.select(F.col("point").alias("b"), F.col(column).alias("y")), "b")

        schema = "a long, b long, common long, total long"
        bounded = fused(sides(new, "sketch"), ["a", "b", "n", "m", "x", "y"], [_bounding(percent)], f"{schema}, maybe boolean")
        bounded = written(bounded, f"{folder}/bounds{turn}")
        measured = fused(sides(bounded.where("maybe").select("a", "b"), "shingles"), ["a", "b", "x", "y"], [_measuring], schema)
        # the filter may have let through a second copy of a set
        measured = measured.unionAll(bounded.where("NOT maybe").drop("maybe")).dropDuplicates(["a", "b"])
        measured = written(measured, f"{folder}/pairs{turn}")
        known = measured if known is None else known.unionAll(measured)

        links = measured.where(_near(percent)).select("a", "b")
        if links.take(1):
            roots = components(roots.toDF("a", "b").unionAll(links))
        ranked = ranked.drop("root").join(roots.withColumnRenamed("node", "point"), "point", "left")
        ranked = written(ranked.withColumn("root", F.coalesce("root", "point")), f"{folder}/rooted{turn}")

        # members near a pivot, and how near to it points of other components may be; sizes bound
        # the distances that were not measured
        near = known.where(_near(percent)).withColumn("d", F.expr("1 - common / (total - common)"))
        near = near.selectExpr("a AS point", "b AS pivot", "d").unionAll(near.selectExpr("b AS point", "a AS pivot", "d"))
        chosen = ranked.where("is_pivot").select("region", F.col("point").alias("pivot"))
        near = near.join(ranked.select("region", "point"), "point").join(chosen, ["region", "pivot"])
        near = written(near, f"{folder}/near{turn}")
        pairs = _with_pivots(ranked, near.select("region", "pivot").distinct())
        pairs = pairs.withColumns({"a": F.least("point", "pivot"), "b": F.greatest("point", "pivot")})
        far = F.expr("coalesce(1 - common / (total - common), 1 - least(n, pn) / greatest(n, pn))")
        edge = pairs.join(known, ["a", "b"], "left").groupBy("region", "pivot").agg(F.min(far).alias("m"))
        settled = near.join(edge, ["region", "pivot"], "left").where(f"m IS NULL OR d < m - {radius} - 1e-9")
        settled = settled.select("region", "point").distinct()
        rest = ranked.where("NOT is_pivot").select("region", "point", "n", "i", "root")
        rest = rest.join(settled, ["region", "point"], "left_anti")
        several = rest.groupBy("region").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s")
        turn += 1
        members = written(rest.join(several.select("region"), "region"), f"{folder}/members{turn}")
    return roots


def _with_pivots(ranked: DataFrame, some: DataFrame | None = None) -> DataFrame:
    """The members of every region with its pivots (or some of these) of other components."""
    pivots = ranked.where("is_pivot").select(
        "region",
        F.col("point").alias("pivot"),
        F.col("n").alias("pn"),
        F.col("i").alias("pi"),
        F.col("root").alias("proot"),
    )
    if some is not None:
        pivots = pivots.join(some, ["region", "pivot"], "left_semi")
    return ranked.join(pivots, "region").where("root != proot")


def classes(about: DataFrame, docs: DataFrame, id_column: str, text_column: str, size: int, percent: int) -> DataFrame:
    """(point, least, root): the least id of every point, and the component that it is in."""
    # one row per point before anything is joined, so that copies are not carried along
    points = about.where("point IS NOT NULL").groupBy("point").agg(F.min(id_column).alias("least"))
    roots = linked_points(docs, about, id_column, text_column, size, percent)
    return points.join(roots, points["point"] == roots["node"], "left").select(
        "point", "least", F.coalesce("root", "point").alias("root")
    )


def describe(docs: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """Id, point (null: no shingles) and number of shingles of every row."""
    kind = docs.schema[id_column].dataType.simpleString()
    step = _describing(id_column, text_column, size)
    return fused(docs, [id_column, text_column], [step], f"`{id_column}` {kind}, point long, n_shingles long")


def join(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Per row: the id, `n_shingles`, and `component_id`, the least id that its links reach.

    Two texts link when 100 times their common shingles reach `percent` times their united
    ones. Null or empty texts, and those without words, have no shingles and link with nothing:
    their component is their own id. Equal texts are one point, so repeated rows get equal
    results. Null ids never name a component that holds another id.
    """
    about = written(describe(docs, id_column, text_column, size), f"{scratch(docs.sparkSession)}/about")
    rooted = classes(about, docs, id_column, text_column, size, percent)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_point = rooted.join(named, "root").select("point", "component_id")
    return about.join(by_point, "point", "left").select(
        id_column,
        "n_shingles",
        F.when(F.col("point").isNull(), F.col(id_column)).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """The rows, with all their columns, without all but one of every component of `join`.

    The row with the least id stays (a null id only where no other is; of rows that share it,
    one). Rows without shingles stay.
    """
    folder = scratch(docs.sparkSession)
    about = written(describe(docs, id_column, text_column, size), f"{folder}/about")
    rooted = classes(about, docs, id_column, text_column, size, percent)
    best = F.min(F.struct(F.col("least").isNull().alias("n"), F.col("least").alias("i"), F.col("point").alias("p")))
    chosen = rooted.groupBy("root").agg(best.alias("b")).select(F.col("b.i").alias("_i"), F.col("b.p").alias("_point"))

    name = "_point"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"

    def step(batches: Batches) -> Batches:
        describing = _describing("_id", "_text", size)
        for batch in pieces(batches, text_column, PIECE):
            texts = batch.column(text_column)
            own = pa.record_batch([pa.nulls(len(texts), pa.int64()), texts], names=["_id", "_text"])
            for found in describing(iter([own])):
                yield pa.record_batch(
                    [*batch.columns, found.column("point")], names=[*batch.schema.names, name]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    placed = fused(docs, [f"`{c}`" for c in docs.columns], [step], f"{schema}, {name} long")
    chosen = chosen.withColumnsRenamed({"_i": f"{name}_i", "_point": f"{name}_p"})
    same = (placed[name] == chosen[f"{name}_p"]) & placed[id_column].eqNullSafe(chosen[f"{name}_i"])
    stay = placed.where(placed[name].isNotNull()).join(chosen, same, "left_semi").dropDuplicates([name, id_column])
    return stay.unionAll(placed.where(placed[name].isNull())).drop(name)
