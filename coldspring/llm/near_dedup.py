"""MinHash near-duplicates by an inverted join of signature coordinates.

Every distinct shingle set (class) is posted under (coordinate, value) pairs of its signature. Two sets
that agree in at least ``matches`` of ``coordinates`` must agree in one of any
``coordinates - matches + 1`` of them (prefix filter), so only that many, the rarest, are posted.

The sets of one posting list are not paired with each other. First each meets the least member of its
lists (its leaders): collisions of the two signatures are counted, pairs below ``matches`` are skipped, the
others are confirmed on the full sets. Components of these links follow. What is left are the lists whose
members are in different components; only those are compared member by member, in square blocks of
bounded size inside a task, which give links and never pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.llm import textkit
from coldspring.llm.components import components
from coldspring.workspace import Workspace

CELLS, CELL_BLOCK = 1 << 16, 1 << 12
FILTER_BITS, FILTER_BLOCK = 1 << 25, 1 << 19


@dataclass(frozen=True)
class NearConfig:
    """A link of Jaccard similarity 0.8 agrees in 51 of 64 coordinates on average, with a deviation of 3.2;
    fewer than 34 have a chance of about one in a million."""
    width: int = 5          # words of a shingle
    percent: int = 80       # least similarity of a link
    coordinates: int = 64
    matches: int = 34
    block: int = 2048       # members of one side of a block

    @property
    def prefix(self) -> int:
        return self.coordinates - self.matches + 1


def _family(config: NearConfig) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(64)
    flips = draw.integers(0, 1 << 32, config.coordinates, dtype=np.uint32)
    factors = draw.integers(0, 1 << 31, config.coordinates, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return flips[:, None], factors[:, None]


def signature(values: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Per coordinate the least image of the set. Sets are cut into pieces so that memory stays bounded."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(flips), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), 8192):
        out = np.minimum(out, ((short[None, at:at + 8192] ^ flips) * factors).min(axis=1))
    return out


def _features(config: NearConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips, factors = _family(config)
        for batch in batches:
            texts = textkit.utf8(batch.column("_text"))
            for a, b in textkit.pieces(texts):
                sets = textkit.shingle_sets(texts[a:b], config.width)
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([signature(s, flips, factors).tobytes() if len(s) else None for s in sets], pa.binary()),
                ], names=["_id", "_n", "_key", "_sig"])
    return run


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    """Equal-length binary values as rows."""
    values = column.to_pylist()
    if not values:
        return np.empty((0, 0), dtype=dtype)
    return np.frombuffer(b"".join(values), dtype=dtype).reshape(len(values), -1)


def _tokens(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit name of every (coordinate, value)."""
    place = np.arange(signatures.shape[1], dtype=np.uint64)[None, :]
    return textkit.mixed((signatures.astype(np.uint64) << np.uint64(12)) | place)


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(48)).astype(np.int64)


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(CELLS, dtype=np.int64)
    for batch in batches:
        if batch.num_rows:
            held += np.bincount(_cells(_tokens(_matrix(batch.column("_sig"), np.uint32))).ravel(), minlength=CELLS)
    blocks = np.flatnonzero(held.reshape(-1, CELL_BLOCK).any(axis=1))
    yield pa.RecordBatch.from_arrays([
        pa.array(blocks, pa.int32()), pa.array([held[b * CELL_BLOCK:(b + 1) * CELL_BLOCK].tobytes() for b in blocks], pa.binary())],
        names=["_block", "_counts"])


def _add_cells(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v, dtype=np.int64) for v in table.column("_counts").to_pylist())
    return pa.table({"_block": table.column("_block").slice(0, 1), "_counts": pa.array([total.tobytes()], pa.binary())})


def token_counts(nodes: DataFrame) -> np.ndarray:
    """How often the (coordinate, value) pairs of each of 65,536 hash cells occur: half a megabyte whatever the
    input. It only orders the pairs from rare to frequent, any order gives right results."""
    rows = (nodes.select("_sig").mapInArrow(_count_cells, "_block int, _counts binary")
            .groupBy("_block").applyInArrow(_add_cells, "_block int, _counts binary").collect())
    counts = np.zeros(CELLS, dtype=np.int64)
    for row in rows:
        counts[row["_block"] * CELL_BLOCK:(row["_block"] + 1) * CELL_BLOCK] = np.frombuffer(row["_counts"], dtype=np.int64)
    return counts


def _postings(config: NearConfig, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                tokens = _tokens(_matrix(part.column("_sig"), np.uint32))
                rank = (counts[_cells(tokens)].astype(np.uint64) << np.uint64(24)) | (tokens & np.uint64(0xFFFFFF))
                rare = np.argpartition(rank, config.prefix - 1, axis=1)[:, :config.prefix]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.take_along_axis(tokens, rare, axis=1).ravel().view(np.int64)),
                    pa.array(np.repeat(part.column("_node").to_numpy(), config.prefix))], names=["_token", "_node"])
    return run


def _collide(config: NearConfig):
    """Keeps the pairs whose signatures collide often enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = _matrix(batch.column("_sig"), np.uint32) == _matrix(batch.column("_lead_sig"), np.uint32)
                yield batch.select(["_lead", "_node"]).filter(pa.array(same.sum(axis=1) >= config.matches))
    return run


def _spots(nodes: np.ndarray) -> np.ndarray:
    h = textkit.mixed(nodes.astype(np.uint64))
    return np.concatenate([h % np.uint64(FILTER_BITS), (h >> np.uint64(32)) % np.uint64(FILTER_BITS)]).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS, dtype=bool)
    for batch in batches:
        bits[_spots(batch.column("_node").to_numpy())] = True
    blocks = np.flatnonzero(bits.reshape(-1, FILTER_BLOCK).any(axis=1))
    yield pa.RecordBatch.from_arrays([
        pa.array(blocks, pa.int32()), pa.array([np.packbits(bits[b * FILTER_BLOCK:(b + 1) * FILTER_BLOCK]).tobytes() for b in blocks], pa.binary())],
        names=["_block", "_bits"])


def _join_marks(table: pa.Table) -> pa.Table:
    joined = np.bitwise_or.reduce([np.frombuffer(v, dtype=np.uint8) for v in table.column("_bits").to_pylist()])
    return pa.table({"_block": table.column("_block").slice(0, 1), "_bits": pa.array([joined.tobytes()], pa.binary())})


def _sets(config: NearConfig, bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            spots = _spots(ids).reshape(2, -1)
            batch = batch.filter(pa.array(bits[spots[0]] & bits[spots[1]]))
            texts = textkit.utf8(batch.column("_text"))
            for a, b in textkit.pieces(texts):
                sets = textkit.shingle_sets(texts[a:b], config.width)
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").slice(a, b - a), pa.array([s.tobytes() for s in sets], pa.binary())], names=["_node", "_set"])
    return run


def full_sets(source: DataFrame, nodes: DataFrame, config: NearConfig, workspace: Workspace, name: str) -> DataFrame:
    """(_node, _set) for the texts of ``nodes``, and of some others that a filter of four megabytes cannot tell from them:
    the texts need not be shuffled, and the joins that follow ignore the others."""
    rows = (nodes.select("_node").distinct().mapInArrow(_mark, "_block int, _bits binary")
            .groupBy("_block").applyInArrow(_join_marks, "_block int, _bits binary").collect())
    bits = np.zeros(FILTER_BITS, dtype=bool)
    for row in rows:
        bits[row["_block"] * FILTER_BLOCK:(row["_block"] + 1) * FILTER_BLOCK] = np.unpackbits(np.frombuffer(row["_bits"], dtype=np.uint8)).astype(bool)
    kept = source.filter(F.col("_id").isNotNull()).mapInArrow(_sets(config, bits), "_node long, _set binary")
    return workspace.stage(kept, name)


def _hash_sets(column) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype=np.uint64) for v in column.to_pylist()]


def _linked(shared, a, b, percent: int):
    return 100 * shared >= percent * (a + b - shared)


def _confirm_star(config: NearConfig):
    """One leader and some members: links of the two where the full sets confirm it."""
    def run(table: pa.Table) -> pa.Table:
        node, lead = table.column("_node").to_numpy(), table.column("_lead")[0].as_py()
        sets = _hash_sets(table.column("_set"))
        found = []
        for leader in (s for s, n in zip(sets, node) if n == lead):
            for s, n in zip(sets, node):
                if n != lead and len(leader):
                    at = np.minimum(np.searchsorted(leader, s), len(leader) - 1)
                    if _linked(int((leader[at] == s).sum()), len(leader), len(s), config.percent):
                        found.append(n)
        return pa.table({"a": pa.array([lead] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})
    return run


def _candidates(signatures: np.ndarray, root: np.ndarray, side: np.ndarray, matches: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each member, the later ones in another component, and in the other block if there are two, that
    collide often enough."""
    two = len(np.unique(side)) > 1
    for x in range(len(root) - 1):
        later = np.flatnonzero(root[x + 1:] != root[x]) + x + 1
        if two:
            later = later[side[later] != side[x]]
        if len(later):
            yes = later[(signatures[later] == signatures[x]).sum(axis=1) >= matches]
            if len(yes):
                yield x, yes


def _needed(config: NearConfig):
    """The members of a block that collide with a member of another component."""
    def run(table: pa.Table) -> pa.Table:
        need = np.zeros(table.num_rows, dtype=bool)
        for x, others in _candidates(_matrix(table.column("_short"), np.uint8), table.column("_root").to_numpy(), table.column("_side").to_numpy(), config.matches):
            need[x] = True
            need[others] = True
        return table.filter(pa.array(need))
    return run


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of 0/1 matrices over slices of the common values."""
    counts = np.zeros((len(left), len(right)), dtype=np.float64)
    common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    for at in range(0, len(common), 4096):
        words = common[at:at + 4096]

        def rows(sets):
            out = np.zeros((len(sets), len(words)), dtype=np.float32)
            for i, s in enumerate(sets):
                part = s[np.searchsorted(s, words[0]):np.searchsorted(s, words[-1], side="right")]
                place = np.minimum(np.searchsorted(words, part), len(words) - 1)
                out[i, place[words[place] == part]] = 1
            return out
        counts += rows(left) @ rows(right).T
    return counts.astype(np.int64)


def _confirm_block(config: NearConfig):
    """A spanning set of the links between different components in one block."""
    def run(table: pa.Table) -> pa.Table:
        node, root, side = (table.column(c).to_numpy() for c in ("_node", "_root", "_side"))
        sets = _hash_sets(table.column("_set"))
        group = {r: r for r in root.tolist()}

        def top(r):
            while group[r] != r:
                group[r] = group[group[r]]
                r = group[r]
            return r
        found = []
        pending = list(_candidates(_matrix(table.column("_short"), np.uint8), root, side, config.matches))
        for at in range(0, len(pending), 256):
            part = pending[at:at + 256]
            columns = np.unique(np.concatenate([ys for _, ys in part]))
            counts = shared_counts([sets[x] for x, _ in part], [sets[y] for y in columns])
            for i, (x, ys) in enumerate(part):
                sizes = np.fromiter((len(sets[y]) for y in ys), dtype=np.int64)
                yes = _linked(counts[i, np.searchsorted(columns, ys)], len(sets[x]), sizes, config.percent)
                for y in ys[yes]:
                    p, q = top(root[x].item()), top(root[y].item())
                    if p != q:
                        group[p] = q
                        found.append((node[x].item(), node[y].item()))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return run


def near_groups(docs: DataFrame, workspace: Workspace, config: NearConfig = NearConfig(),
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, n_shingles, component_id, kept) per row of ``docs``.

    Words are maximal runs of bytes other than ASCII white space, with A-Z lower-cased. A document's set are its
    distinct ``width``-word shingles; with fewer words, the whole sequence; null, empty and blank texts have an empty
    set and link with nothing. Documents link if 100 * shared >= percent * union. component_id is the smallest
    id that can be reached, kept tells whether that is the document itself.

    Rows that share an id are one document: their links are joined. Rows with a null id take the component of the equal sets
    that have an id; without any, component_id is null and kept is true. Shingles are compared by 64-bit hashes. Only
    the id and text columns are read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    features = workspace.stage(source.mapInArrow(_features(config), "_id long, _n long, _key binary, _sig binary"), "near-features")
    # Equal sets are one class, named by its smallest id.
    classes = features.filter(F.col("_n") > 0).groupBy("_key").agg(F.min("_id").alias("_node"), F.first("_sig").alias("_sig"))
    classes = workspace.stage(classes, "near-classes")
    nodes = classes.filter(F.col("_node").isNotNull()).select("_node", "_sig")

    counts = token_counts(nodes)
    postings = nodes.mapInArrow(_postings(config, counts), "_token long, _node long")
    leaders = postings.groupBy("_token").agg(F.min("_node").alias("_lead"), F.max("_node").alias("_last")).filter("_lead != _last")
    lists = workspace.stage(postings.join(leaders.select("_token", "_lead"), "_token").select("_lead", "_node").distinct(), "near-lists")

    # The joins that follow are sort-merge joins at every size, so that small runs tell what large ones need.
    stars = (lists.filter("_lead != _node").join(nodes.hint("merge"), "_node")
             .join(nodes.hint("merge").select(F.col("_node").alias("_lead"), F.col("_sig").alias("_lead_sig")), "_lead")
             .mapInArrow(_collide(config), "_lead long, _node long"))
    stars = workspace.stage(stars, "near-stars")

    met = stars.select("_node").union(stars.select("_lead"))
    sets = full_sets(source, met, config, workspace, "near-star-sets")

    # A leader's members are cut into parts of bounded size, each with its own copy of the leader.
    per_leader = stars.groupBy("_lead").agg(F.ceil(F.count(F.lit(1)) / config.block).alias("_parts"))
    members = stars.join(per_leader, "_lead").select("_lead", "_node", F.pmod(F.xxhash64("_node"), "_parts").alias("_part"))
    copies = per_leader.select("_lead", F.col("_lead").alias("_node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"))
    links = (members.unionByName(copies).join(sets.hint("merge"), "_node")
             .groupBy("_lead", "_part").applyInArrow(_confirm_star(config), "a long, b long"))
    # Rows that share an id but not their text are one document.
    named = features.filter("_n > 0 and _id is not null").join(classes.select("_key", "_node"), "_key")
    same_id = named.groupBy("_id").agg(F.min("_node").alias("a"), F.max("_node").alias("b")).filter("a != b").select("a", "b")
    links = workspace.stage(links.union(same_id), "near-links")
    roots = components(links, workspace, "near-roots")

    # Lists whose members are not all in one component; a list of two has been settled above.
    placed = lists.union(lists.select("_lead", "_lead").distinct()).distinct().join(roots.withColumnRenamed("node", "_node"), "_node", "left")
    placed = workspace.stage(placed.select("_lead", "_node", F.coalesce("root", "_node").alias("_root")), "near-placed")
    open_lists = (placed.groupBy("_lead").agg(F.min("_root").alias("_r0"), F.max("_root").alias("_r1"), F.count(F.lit(1)).alias("_size"))
                  .filter("_r0 != _r1 and _size > 2").select("_lead", F.ceil(F.col("_size") / config.block).alias("_blocks")))
    rows = placed.join(open_lists, "_lead").join(_short_signatures(nodes), "_node")
    own = F.pmod(F.xxhash64("_node"), "_blocks")
    cells = (rows.withColumn("_side", own)
             .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
             .withColumn("_i", F.least("_side", "_other")).withColumn("_j", F.greatest("_side", "_other"))
             .select("_lead", "_i", "_j", "_side", "_node", "_root", "_short"))
    schema = "_lead long, _i long, _j long, _side long, _node long, _root long, _short binary"
    needed = workspace.stage(cells.groupBy("_lead", "_i", "_j").applyInArrow(_needed(config), schema), "near-needed")
    sets = full_sets(source, needed, config, workspace, "near-block-sets")
    more = (needed.join(sets.hint("merge"), "_node").groupBy("_lead", "_i", "_j")
            .applyInArrow(_confirm_block(config), "a long, b long"))
    roots = components(links.union(more), workspace, "near-roots")

    # A node can name two classes that share an id: they are one document as well.
    place = classes.select("_key", "_node").join(roots.withColumnRenamed("node", "_node"), "_node", "left")
    out = features.join(place.select("_key", F.coalesce("root", "_node").alias("_root")), "_key", "left")
    component = F.when(F.col("_n") > 0, F.col("_root")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("_id") == component, component.isNull()).alias("kept"))


def _short_signatures(nodes: DataFrame) -> DataFrame:
    """One byte of each coordinate: enough to skip, never to lose a collision."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                # least values have zeros in their high bits, so they are spread first
                low = ((_matrix(batch.column("_sig"), np.uint32) * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column("_node"), pa.array([r.tobytes() for r in low], pa.binary())], names=["_node", "_short"])
    return nodes.mapInArrow(run, "_node long, _short binary")
