"""Near-duplicate vectors by NN-descent.

A neighbour graph starts from random hyperplane cells and is refined through joins of
neighbours of neighbours. Edges at or above the threshold give components. A vector
whose list holds nothing below the threshold is saturated: its list is enlarged to its
whole component, compared in blocks, and saturated vectors search again among those of
other components, from fresh cells. Every pair at the threshold that any block meets
counts as a link, whether or not it stays in a list.
A sample is compared with all vectors to audit the recall; short of it, descent goes on,
and it is an error if the last attempt falls short too. Large cells and hubs are cut
anew in every table, hub, round and attempt.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import slices
from opinara.llm.components import components
from opinara.session import saved

NEIGHBOURS = 12
TABLES = 6
CELL = 256
BLOCK = 512
_LIST = "array<struct<sim: double, id: binary>>"
_STATE = f"id binary, near {_LIST}, link binary"


def _items(vectors: DataFrame) -> tuple[DataFrame, type]:
    """(vec_id, id, vec), id a digest of the vector (null where it links with nothing); and the number type of vec."""
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = np.float32 if single else np.float64

    def run(batches):
        for batch in slices(batches, 2048):
            column = batch.column(1)
            flat, offsets = np.asarray(column.values.cast(pa.float64()).fill_null(np.nan)), np.asarray(column.offsets)
            valid = np.asarray(column.is_valid())
            ids, vecs = [], []
            for k in range(len(column)):
                x = flat[offsets[k] : offsets[k + 1]]
                good = valid[k] and len(x) and np.isfinite(x).all() and x.any()
                raw = (x + 0.0).astype(kind).tobytes() if good else None
                ids.append(hashlib.md5(raw).digest() if good else None)
                vecs.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(vecs, pa.binary())], ["vec_id", "id", "vec"])

    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("e"))
    return kept.mapInArrow(run, "vec_id bigint, id binary, vec binary"), kind


def _matrix(column: list[bytes], kind) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one length as doubles, and their norms."""
    x = np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(np.float64)
    return x, np.sqrt((x * x).sum(axis=1))


def _cosines(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    return (x @ y.T) / (nx[:, None] * ny[None, :])


def _roots(hit: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the first row that it is connected with."""
    root, waiting = np.arange(len(hit)), hit.any(axis=1)
    for r in np.flatnonzero(waiting).tolist():
        front = np.array([r]) if waiting[r] else np.array([], int)
        waiting[r] = False
        while len(front):
            root[front] = r
            front = np.flatnonzero(hit[front].any(axis=0) & waiting)
            waiting[front] = False
    return root


def _met_in(ids: list[bytes], sims: np.ndarray, floors: np.ndarray, k: int, threshold: float) -> pa.Table:
    """For each row its best k columns above its floor, and one row that links at the threshold connect it with."""
    hit = sims >= threshold
    root = _roots(hit | hit.T)
    out_ids, out, links = [], [], []
    k = min(k, sims.shape[1])
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    for r in range(len(ids)):
        found = [{"sim": float(sims[r, c]), "id": ids[c]} for c in best[r].tolist() if sims[r, c] > floors[r]]
        if found or root[r] != r:
            out_ids.append(ids[r])
            out.append(found or None)
            links.append(ids[root[r]] if root[r] != r else None)
    kind = pa.list_(pa.struct([("sim", pa.float64()), ("id", pa.binary())]))
    return pa.table({"id": pa.array(out_ids, pa.binary()), "near": pa.array(out, kind), "link": pa.array(links, pa.binary())})


def _lists(found: DataFrame) -> DataFrame:
    return found.where("near is not null").select("id", "near")


def _links(found: DataFrame) -> DataFrame:
    """(a, b) that connect what links at the threshold connect in the blocks."""
    return found.where("link is not null").select(F.col("id").alias("a"), F.col("link").alias("b"))


def _different(column: pa.ChunkedArray) -> np.ndarray:
    """Which pairs of rows are of different components."""
    codes: dict = {}
    comp = np.array([codes.setdefault(c, len(codes)) for c in column.to_pylist()])
    return comp[:, None] != comp[None, :]


def _cut(*salted) -> Column:
    """A number below the column parts, drawn anew for each value of what follows the id."""
    return F.pmod(F.xxhash64(*salted), "parts")


def _first_graph(items: DataFrame, n: int, kind, seed: int, threshold: float, outside: bool = False) -> DataFrame:
    """(id, near, link) from the cells of TABLES sets of random hyperplanes; large cells are cut into chunks.

    With `outside`, only pairs of different components (column comp of items) count.
    """
    bits = max(1, round(np.log2(max(2, n / CELL))))

    def cells(batches):
        for batch in slices(batches, 1024):
            vecs = batch.column(1).to_pylist()
            sizes = np.array([len(v) for v in vecs])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x, _ = _matrix([vecs[r] for r in rows], kind)
                rng = np.random.default_rng([seed, int(size)])
                signs = (x @ rng.normal(size=(x.shape[1], TABLES * bits)) > 0).reshape(len(rows), TABLES, bits)
                keys = signs @ (1 << np.arange(bits)) + (np.arange(TABLES) << bits)
                taken = batch.take(pa.array(np.repeat(rows, TABLES)))
                yield pa.RecordBatch.from_arrays(
                    [taken.column(0), taken.column(1), taken.column(2), pa.array(keys.ravel() * 1_000_003 + int(size))],
                    ["id", "vec", "comp", "cell"],
                )

    comp = F.col("comp") if outside else F.lit(None).cast("binary").alias("comp")
    dealt = items.select("id", "vec", comp).mapInArrow(cells, "id binary, vec binary, comp binary, cell bigint")
    sizes = saved(dealt.groupBy("cell").agg(F.ceil(F.count("*") / (4 * CELL)).cast("int").alias("parts")), "nn-cells")
    dealt = dealt.join(sizes, "cell").withColumn("chunk", _cut("id", "cell", F.lit(seed)))

    def best(block: pa.Table) -> pa.Table:
        ids = block["id"].to_pylist()
        x, nx = _matrix(block["vec"].to_pylist(), kind)
        sims = _cosines(x, nx, x, nx)
        if outside:
            sims[~_different(block["comp"])] = -2
        np.fill_diagonal(sims, -2)
        return _met_in(ids, sims, np.full(len(ids), -1.5), NEIGHBOURS, threshold)

    return saved(dealt.groupBy("cell", "chunk").applyInArrow(best, _STATE), "nn-first")


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """One list for each id: its best k different neighbours."""
    pool = lists.groupBy("id").agg(F.flatten(F.collect_list("near")).alias("near"))
    return pool.select("id", F.slice(F.sort_array(F.array_distinct("near"), asc=False), 1, k).alias("near"))


def _descended(
    graph: DataFrame, items: DataFrame, n: int, kind, threshold: float, seed: int, guides: DataFrame | None = None, rounds: int = 12
) -> tuple[DataFrame, DataFrame]:
    """The graph after joins of neighbours' neighbours, until fewer than 1 in 1000 entries are new; and the links met.

    With `guides` (id, o), only pairs of different components (column comp of items) count;
    the guides are further neighbours, through which a vector meets those of its company.
    """
    outside = guides is not None
    links = items.sparkSession.createDataFrame([], "a binary, b binary")
    state = saved(graph.withColumn("fresh", F.transform("near", lambda s: s["id"])), "nn-state")

    def joined(block: pa.Table) -> pa.Table:
        ids = block["u"].to_pylist()
        x, nx = _matrix(block["vec"].to_pylist(), kind)
        sims = _cosines(x, nx, x, nx)
        fresh = np.asarray(block["fresh"].combine_chunks())
        # A hub in parts shows other pairs in each round, so there no pair is known to have met.
        skip = np.full(sims.shape, False) if block["parts"][0].as_py() > 1 else ~(fresh[:, None] | fresh[None, :])
        if outside:
            skip |= ~_different(block["comp"])
        sims[skip] = -2
        np.fill_diagonal(sims, -2)
        return _met_in(ids, sims, np.asarray(block["floor"].combine_chunks()), NEIGHBOURS, threshold)

    for number in range(rounds):
        edges = state.select("id", "fresh", F.explode("near.id").alias("o")).select("id", "o", F.expr("array_contains(fresh, o)").alias("new"))
        if outside:
            edges = edges.union(guides.select("id", "o", F.lit(False).alias("new")))
        both = edges.select(F.col("id").alias("v"), F.col("o").alias("u"), "new").union(edges.select(F.col("o").alias("v"), F.col("id").alias("u"), "new"))
        both = saved(both.groupBy("v", "u").agg(F.max("new").alias("fresh")), "nn-edges")
        busy = both.groupBy("v").agg(F.max("fresh").alias("any"), F.ceil(F.count("*") / 128).cast("int").alias("parts")).where("any")
        floor = F.when(F.size("near") >= NEIGHBOURS, F.element_at("near", -1)["sim"]).otherwise(-1.5)
        facts = items.join(state.select("id", floor.alias("floor")), "id", "left").select(F.col("id").alias("u"), "vec", "comp", F.coalesce("floor", F.lit(-1.5)).alias("floor"))
        rows = both.join(saved(busy.drop("any"), "nn-busy"), "v").withColumn("part", _cut("u", "v", F.lit(seed), F.lit(number)))
        found = saved(rows.join(saved(facts, "nn-facts"), "u").groupBy("v", "part", F.octet_length("vec")).applyInArrow(joined, _STATE), "nn-found")
        links = links.union(_links(found))
        merged = _merged(state.select("id", "near").union(_lists(found)), NEIGHBOURS)
        before = state.select("id", F.transform("near", lambda s: s["id"]).alias("was"))
        state = merged.join(before, "id", "left").select(
            "id", "near", F.array_except(F.transform("near", lambda s: s["id"]), F.coalesce("was", F.array().cast("array<binary>"))).alias("fresh")
        )
        state = saved(state, "nn-state")
        if (state.agg(F.sum(F.size("fresh"))).first()[0] or 0) < 0.001 * n * NEIGHBOURS:
            break
    return state.select("id", "near"), links


def _edges(graph: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of entries at the threshold; both orders count, so one is kept."""
    pairs = graph.select("id", F.explode("near").alias("o")).where(F.col("o.sim") >= threshold)
    return pairs.select(F.least("id", "o.id").alias("a"), F.greatest("id", "o.id").alias("b")).distinct()


def _counted(items: DataFrame, comps: DataFrame, kind, threshold: float) -> DataFrame:
    """(id, links, pairs): copies of other items linked with it, and these items; all pairs of each component compared in blocks."""
    mine = saved(items.select("id", "vec", "copies").join(comps, "id"), "nn-members")
    sizes = saved(mine.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), "nn-sizes")
    cut = mine.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cut = cut.select("component", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "id", "vec", "copies")

    def count(block: pa.Table) -> pa.Table:
        chunk, copies = np.asarray(block["chunk"].combine_chunks()), np.asarray(block["copies"].combine_chunks())
        i, j = block["i"][0].as_py(), block["j"][0].as_py()
        x, nx = _matrix(block["vec"].to_pylist(), kind)
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        hit = _cosines(x[left], nx[left], x[right], nx[right]) >= threshold
        links, pairs = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if i == j:
            np.fill_diagonal(hit, False)
        else:
            links[right] += hit.T @ copies[left]
            pairs[right] += hit.sum(axis=0)
        links[left] += hit @ copies[right]
        pairs[left] += hit.sum(axis=1)
        return pa.table({"id": block["id"], "links": pa.array(links), "pairs": pa.array(pairs)})

    blocks = cut.groupBy("component", "i", "j").applyInArrow(count, "id binary, links bigint, pairs bigint")
    return blocks.groupBy("id").agg(F.sum("links").alias("links"), F.sum("pairs").alias("pairs"))


def audited(n: int) -> int:
    """Items in the sample of an audit of n items."""
    return min(n, max(200, math.ceil(4 * math.sqrt(n))))


def audit(items: DataFrame, links: DataFrame, kind, threshold: float, sample: int, seed: int = 0) -> tuple[int, int]:
    """(pairs found, pairs there are) of two samples against all items: `sample` of all items and of those with links.

    Pairs of different items count once, however many copies they have. If neither
    sample has a pair, one of 16 times as many items is taken.
    """
    order = [F.xxhash64("id", F.lit(seed)), F.col("id")]
    linked = links.where("pairs > 0").orderBy(*order).limit(sample).select("id")
    either = items.select("id").orderBy(*order).limit(sample).union(linked).distinct()
    got, there = _audited(items, links, kind, threshold, items.select("id", "vec").join(either, "id", "left_semi"))
    if there:
        return got, there
    return _audited(items, links, kind, threshold, items.orderBy(*order).limit(16 * sample).select("id", "vec"))


def _audited(items: DataFrame, links: DataFrame, kind, threshold: float, sample: DataFrame) -> tuple[int, int]:
    chosen = sample.toArrow().to_pylist()
    place = {r["id"]: k for k, r in enumerate(chosen)}
    sent = items.sparkSession.sparkContext.broadcast((chosen, place))

    def run(batches):
        chosen, place = sent.value
        total = np.zeros(len(chosen), np.int64)
        sizes = np.array([len(r["vec"]) for r in chosen])
        groups = {}
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            groups[size] = [(part, *_matrix([chosen[k]["vec"] for k in part], kind)) for part in np.split(rows, range(4096, len(rows), 4096))]
        for batch in slices(batches, 1024):
            vecs, names = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            own = np.array([len(v) for v in vecs])
            for size in np.intersect1d(sizes, own):
                b = np.flatnonzero(own == size)
                y, ny = _matrix([vecs[k] for k in b], kind)
                for part, x, nx in groups[size]:
                    total[part] += (_cosines(x, nx, y, ny) >= threshold).sum(axis=1)
            # Each chosen item met itself once.
            for k in (place.get(name) for name in names):
                if k is not None:
                    total[k] -= 1
        yield pa.RecordBatch.from_arrays([pa.array([int(total.sum())])], ["pairs"])

    there = items.select("id", "vec").mapInArrow(run, "pairs bigint").agg(F.sum("pairs")).first()[0] or 0
    ids = items.sparkSession.createDataFrame([(r["id"],) for r in chosen], "id binary")
    return (links.join(ids, "id").agg(F.sum("pairs")).first()[0] or 0), there


def vector_links(vectors: DataFrame, threshold: float = 0.95, least_recall: float = 0.99, attempts: int = 3) -> DataFrame:
    """(vec_id, n_links, component_id, kept): a row for each row of vectors (vec_id, embedding).

    n_links is the number of other rows whose vector has a cosine of at least
    `threshold` in double precision; equal vectors link. component_id is the smallest
    vec_id reachable by links, itself included; kept: vec_id = component_id. Vectors
    that are null, empty or zero, or hold null or non-finite components, link with
    nothing, and so do vectors of different lengths. A row repeated with its id counts
    as another row. A row without vec_id links like others and takes its component's
    id. Labels and other columns are not read. An empty table gives no rows.

    If the audit finds fewer than `least_recall` of the links, the graph is joined with a
    fresh set of cells and descends again, at most `attempts` times in all; a last
    attempt that falls short too is an error.
    """
    found, kind = _items(vectors)
    rows = saved(found, "nn-rows")
    items = rows.where("id is not null").groupBy("id").agg(F.any_value("vec").alias("vec"), F.count("*").alias("copies"))
    items = saved(items.withColumn("comp", F.col("id")), "nn-items")
    n = items.count()
    graph, links, comps, edges = None, None, None, None
    for attempt in range(attempts if n > 1 else 0):
        first = _first_graph(items, n, kind, attempt, threshold)
        graph = _merged(_lists(first) if graph is None else _lists(first).union(graph), NEIGHBOURS)
        graph, met = _descended(graph, items, n, kind, threshold, attempt)
        more = _edges(graph, threshold).union(_links(first)).union(met)
        edges = saved((more if edges is None else edges.union(more)).distinct(), "nn-links")
        comps = saved(components(edges), "nn-components")
        # A link that no list holds was squeezed out of both, so both its ends are saturated.
        full = graph.where((F.size("near") >= NEIGHBOURS) & (F.element_at("near", -1)["sim"] >= threshold))
        full = saved(items.drop("comp").join(full.select("id"), "id", "left_semi"), "nn-full")
        n_full = full.count()
        for turn in itertools.count(1):
            crowd = saved(full.join(comps, "id").withColumnRenamed("component", "comp"), "nn-placed")
            if crowd.select("comp").distinct().limit(2).count() < 2:
                break
            more = _outside_links(graph, crowd, n_full, kind, threshold, seed=attempt + 1000 * turn)
            if more.isEmpty():
                break
            edges = saved(edges.union(more).distinct(), "nn-links")
            comps = saved(components(edges), "nn-components")
        links = saved(_counted(items, comps, kind, threshold), "nn-counted")
        got, there = audit(items, links, kind, threshold, audited(n), attempt)
        if got >= least_recall * there:
            break
    else:
        if n > 1:
            raise RuntimeError(f"{attempts} attempts found {got} of {there} audited links, less than a share of {least_recall}")
    spark = vectors.sparkSession
    links = links if links is not None else spark.createDataFrame([], "id binary, links bigint")
    comps = comps if comps is not None else spark.createDataFrame([], "id binary, component binary")
    named = rows.where("id is not null").groupBy("id").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    named = saved(named.join(comps, "id", "left").join(links, "id", "left").withColumn("component", F.coalesce("component", "id")), "nn-named")
    top = saved(named.groupBy("component").agg(F.min("least").alias("component_id")), "nn-top")
    told = saved(named.join(top, "component").select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "nn-told")
    joined = rows.select("vec_id", "id").join(told, "id", "left")
    component = F.when(F.col("id").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept")
    )


def _outside_links(graph: DataFrame, crowd: DataFrame, n: int, kind, threshold: float, seed: int) -> DataFrame:
    """(a, b): links between components of crowd, from fresh cells, the graph's own entries and a descent from both."""
    first = _first_graph(crowd, n, kind, seed, threshold, outside=True)
    among = crowd.select("id", "comp")
    pairs = graph.select("id", F.explode("near").alias("o")).select("id", F.col("o.id").alias("o"), F.col("o.sim").alias("sim"))
    pairs = saved(pairs.join(among, "id").join(among.select(F.col("id").alias("o"), F.col("comp").alias("there")), "o"), "nn-pairs")
    apart = pairs.where("comp <> there")
    both = apart.select("id", "sim", "o").union(apart.select(F.col("o").alias("id"), "sim", F.col("id").alias("o")))
    start = both.select("id", F.array(F.struct("sim", F.col("o").alias("id"))).alias("near")).union(_lists(first))
    guides = pairs.where("comp = there").select("id", "o")
    found, met = _descended(_merged(start, NEIGHBOURS), crowd, n, kind, threshold, seed, guides)
    return saved(_edges(found, threshold).union(_links(first)).union(met).distinct(), "nn-links")
