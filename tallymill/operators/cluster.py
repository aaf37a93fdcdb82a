"""Density clustering (HDBSCAN with its defaults) and cluster identities.

The kernel is exact and quadratic in the rows of one call and runs inside one grouped task. A group beyond MAX_GROUP
rows is spread over pairs of blocks, exactly as well: every edge lies in one pair, so the spanning tree of the group lies
in the union of the pairs' trees. Ties between equal edges go by the order of the rows, which is the canonical one: in the
kernel as Prim's algorithm meets them from row 0, over blocks by the places of their ends.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymill import schema
from tallymill.session import materialize

MAX_GROUP = 20_000  # rows that one task clusters by itself
BLOCK_ROWS = 2_000
_ENDS = 31  # bits of a row's place within an edge's code


def _spanning_tree(x: np.ndarray, core: np.ndarray) -> np.ndarray:
    """Minimum spanning tree of the mutual reachability distances, row by row from row 0: (n - 1) x (from, to, length)."""
    n = len(x)
    left = np.ones(n, dtype=bool)
    best, source = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
    edges, here = np.empty((n - 1, 3)), 0
    squares = (x * x).sum(axis=1)
    for k in range(n - 1):
        left[here] = False
        d = np.sqrt(np.maximum(squares + squares[here] - 2 * (x @ x[here]), 0.0))
        reach = np.maximum(np.maximum(d, core), core[here])
        closer = left & (reach < best)
        best[closer], source[closer] = reach[closer], here
        there = int(np.where(left, best, np.inf).argmin())
        edges[k] = source[there], there, best[there]
        here = there
    return edges


def _merges(edges: np.ndarray, n: int, kind: str | None = None) -> list[tuple[int, int, float, int]]:
    """Single linkage: (left, right, length, size) of node n + k at merge k."""
    parent, node, size = list(range(n)), list(range(n)), [1] * (2 * n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for k, e in enumerate(edges[np.argsort(edges[:, 2], kind=kind)]):
        a, b = root(int(e[0])), root(int(e[1]))
        total = size[node[a]] + size[node[b]]
        out.append((node[a], node[b], float(e[2]), total))
        size[n + k] = total
        parent[b] = a
        node[a] = n + k
    return out


def _points(merges: list, node: int, n: int) -> list[int]:
    stack, out = [node], []
    while stack:
        v = stack.pop()
        if v < n:
            out.append(v)
        else:
            stack += merges[v - n][:2]
    return out


def hdbscan_labels(x: np.ndarray, min_cluster_size: int = 5) -> np.ndarray:
    """Label of each row, -1 for noise; excess-of-mass selection, the root is never a cluster."""
    n, m = len(x), min_cluster_size
    labels = np.full(n, -1, dtype=np.int64)
    if n < max(m, 2):
        return labels
    squares = (x * x).sum(axis=1)
    core = np.empty(n)
    for i in range(0, n, 1024):
        d = np.sqrt(np.maximum(squares[i : i + 1024, None] + squares[None] - 2 * (x[i : i + 1024] @ x.T), 0.0))
        core[i : i + 1024] = np.partition(d, min(m, n) - 1, axis=1)[:, min(m, n) - 1]
    return _select(_merges(_spanning_tree(x, core), n), n, m)


def _select(merges: list, n: int, m: int) -> np.ndarray:
    """Labels from the single linkage: condensed tree and excess of mass."""
    labels = np.full(n, -1, dtype=np.int64)
    size = lambda v: 1 if v < n else merges[v - n][3]
    born, mass, parts, falls = {0: 0.0}, {0: 0.0}, {0: []}, {0: []}
    stack = [(2 * n - 2, 0)]
    while stack:
        v, c = stack.pop()
        a, b, length, _ = merges[v - n]
        density = 1.0 / length if length > 0 else np.inf
        big = [w for w in (a, b) if size(w) >= m]
        gain = (lambda k: k * (density - born[c])) if np.isfinite(density) else (lambda k: 0.0 if density == born[c] else np.inf * k)
        if len(big) == 2:
            for w in (a, b):
                mass[c] += gain(size(w))
                child = len(born)
                born[child], mass[child], parts[child], falls[child] = density, 0.0, [], []
                parts[c].append(child)
                stack.append((w, child))
            continue
        for w in (a, b):
            if w in big:
                stack.append((w, c))
            else:
                mass[c] += gain(size(w))
                falls[c] += _points(merges, w, n)
    chosen: dict[int, bool] = {}
    for c in sorted(born, reverse=True):
        below = sum(mass[k] for k in parts[c])
        chosen[c] = c != 0 and not (parts[c] and below > mass[c])
        if not chosen[c]:
            mass[c] = max(below, mass[c]) if c else mass[c]
            mass[c] = below if parts[c] else mass[c]
    label = 0
    walk = [0]
    while walk:
        c = walk.pop(0)
        if not chosen[c]:
            walk += parts[c]
            continue
        inside = [c]
        while inside:
            k = inside.pop()
            labels[falls[k]] = label
            inside += parts[k]
        label += 1
    return labels


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * (x @ y.T), 0.0))


def _pair_tree(reach: np.ndarray, at: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spanning tree of a pair of blocks (of one block, if inside): codes of the edges and their lengths.

    Rows of reach are the first places of at, columns the rest (the same, if inside). Of equal edges the lesser code
    counts as shorter, so the tree is the only one.
    """
    p, n = len(reach), len(at)
    left = np.ones(n, dtype=bool)
    best, code = np.full(n, np.inf), np.full(n, np.iinfo(np.int64).max)
    codes, lengths, here = np.empty(n - 1, dtype=np.int64), np.empty(n - 1), 0
    for k in range(n - 1):
        left[here] = False
        if inside:
            to, d = slice(0, n), reach[here]
        elif here < p:
            to, d = slice(p, n), reach[here]
        else:
            to, d = slice(0, p), reach[:, here - p]
        c = (np.minimum(at[to], at[here]) << _ENDS) | np.maximum(at[to], at[here])
        closer = left[to] & ((d < best[to]) | ((d == best[to]) & (c < code[to])))
        best[to][closer], code[to][closer] = d[closer], c[closer]
        open_ = np.where(left, best, np.inf)
        tied = np.flatnonzero(open_ == open_.min())
        here = int(tied[code[tied].argmin()])
        codes[k], lengths[k] = code[here], best[here]
    return codes, lengths


def _forest(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the edges of the least spanning forest, shortest first."""
    ends, flat = np.unique(np.concatenate([codes >> _ENDS, codes & ((1 << _ENDS) - 1)]), return_inverse=True)
    order = np.lexsort((codes, lengths))
    a, b = flat[: len(codes)][order].tolist(), flat[len(codes) :][order].tolist()
    parent, kept = list(range(len(ends))), []
    for k in range(len(order)):
        i, j = a[k], b[k]
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        while parent[j] != j:
            parent[j] = parent[parent[j]]
            j = parent[j]
        if i != j:
            parent[j] = i
            kept.append(k)
            if len(kept) == len(ends) - 1:
                break
    return order[kept]


def _cluster_blocks(flat: DataFrame, by: list[str], m: int) -> DataFrame:
    """(grp, key, label) of groups of any size: core distances and spanning trees by pairs of blocks.

    A task holds two blocks and their distances; the last one holds a group's places and the edges of the square root of
    its blocks' number of forests, but no vectors.
    """
    known = F.col("vec").isNotNull() & (F.size("vec") > 0)
    rows = flat.where(known).withColumn("pos", (F.row_number().over(Window.partitionBy("grp").orderBy(*by, "key")) - 1).cast("bigint"))
    rows = materialize(rows.select("grp", "key", "pos", F.expr(f"cast(pos div {BLOCK_ROWS} as int)").alias("block"), "vec"), "cluster-rows")
    blocks = rows.groupBy("grp").agg((F.max("block") + 1).alias("blocks"))

    def met(df: DataFrame) -> DataFrame:
        spread = df.join(blocks, "grp").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return spread.withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")})

    def sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, np.ndarray]:
        pdf = pdf.sort_values("pos")
        left, right = pdf[pdf["block"] == pdf["i"]], pdf[pdf["block"] == pdf["j"]]
        return left, right, _distances(np.stack(left["vec"].to_numpy()), np.stack(right["vec"].to_numpy()))

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, d = sides(pdf)
        least = lambda v: np.partition(v, min(m, v.shape[1]) - 1, axis=1)[:, :m]
        at, near = list(left["pos"]), list(least(d))
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
            at, near = at + list(right["pos"]), near + list(least(d.T))
        return pd.DataFrame({"grp": pdf["grp"].iloc[0], "pos": at, "near": near})

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, d = sides(pdf)
        inside = bool(pdf["i"].iloc[0] == pdf["j"].iloc[0])
        reach = np.maximum(np.maximum(d, left["core"].to_numpy()[:, None]), right["core"].to_numpy()[None])
        at = left["pos"].to_numpy() if inside else np.concatenate([left["pos"].to_numpy(), right["pos"].to_numpy()])
        codes, lengths = _pair_tree(reach, at, inside)
        part = (int(pdf["i"].iloc[0]) + int(pdf["j"].iloc[0])) % max(1, int(pdf["blocks"].iloc[0] ** 0.5))
        return pd.DataFrame({"grp": pdf["grp"].iloc[0], "part": part, "code": codes, "length": lengths})

    def thin(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[_forest(pdf["code"].to_numpy(), pdf["length"].to_numpy())]

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = thin(pdf)
        code, n = pdf["code"].to_numpy(), len(pdf) + 1
        edges = np.stack([code >> _ENDS, code & ((1 << _ENDS) - 1), pdf["length"].to_numpy()], axis=1)
        found = _select(_merges(edges, n, "stable"), n, m) if n >= max(m, 2) else np.full(n, -1, dtype=np.int64)
        return pd.DataFrame({"grp": pdf["grp"].iloc[0], "pos": np.arange(n), "label": found})

    near = met(rows.drop("key")).groupBy("grp", "i", "j").applyInPandas(nearest, "grp string, pos bigint, near array<double>")
    core = near.groupBy("grp", "pos").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
    core = materialize(core.select("grp", "pos", F.element_at("near", F.least(F.lit(m), F.size("near"))).alias("core")), "cluster-cores")
    edges = met(rows.drop("key").join(core, ["grp", "pos"])).groupBy("grp", "i", "j").applyInPandas(tree, "grp string, part int, code bigint, length double")
    edges = materialize(edges.groupBy("grp", "part").applyInPandas(thin, edges.schema), "cluster-edges")
    labels = edges.groupBy("grp").applyInPandas(label, "grp string, pos bigint, label bigint")
    placed = rows.select("grp", "pos", "key").join(labels, ["grp", "pos"], "left").select("grp", "key", F.coalesce("label", F.lit(-1)).cast("bigint").alias("label"))
    return placed.unionByName(flat.where(~F.coalesce(known, F.lit(False))).select("grp", "key", F.lit(-1).cast("bigint").alias("label")))


def cluster_rows(vectors: DataFrame, key: str = "record_id", vec: str = "vec", group: str | None = None, order: tuple[str, ...] = (), min_cluster_size: int = 5) -> DataFrame:
    """(group, key, label): HDBSCAN inside each group; labels below zero are noise.

    A group of more than MAX_GROUP rows goes over pairs of blocks. Rows with null or empty vectors are noise of their own.
    """
    g = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    kind = vectors.schema[key].dataType.simpleString()
    base = vectors.select(g.alias("grp"), F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("vec"), F.struct(*(order or (key,))).alias("ord"))
    flat = base.select("grp", "key", "vec", *[F.col(f"ord.{c}").alias(f"o{i}") for i, c in enumerate(order or (key,))])
    by = [c for c in flat.columns if c.startswith("o")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(by, kind="stable")
        known = pdf["vec"].map(lambda v: v is not None and len(v) > 0).to_numpy()
        label = np.full(len(pdf), -1, dtype=np.int64)
        if known.any():
            label[known] = hdbscan_labels(np.stack(pdf["vec"].to_numpy()[known]), min_cluster_size)
        return pd.DataFrame({"grp": pdf["grp"], "key": pdf["key"], "label": label})

    large = [r["grp"] for r in base.groupBy("grp").count().where(F.col("count") > MAX_GROUP).select("grp").collect()]
    if not large:
        return flat.groupBy("grp").applyInPandas(run, f"grp string, key {kind}, label bigint")
    small = flat.where(~F.col("grp").isin(large)).groupBy("grp").applyInPandas(run, f"grp string, key {kind}, label bigint")
    return small.unionByName(_cluster_blocks(flat.where(F.col("grp").isin(large)), by, min_cluster_size))


def cluster_ids(labels: DataFrame) -> DataFrame:
    """(key, cluster_id): content-derived ids of the clusters, 'noise' for labels below zero."""
    ids = labels.where("label >= 0").groupBy("grp", "label").agg(schema.cluster_id(F.collect_list(F.col("key").cast("string"))).alias("cluster_id"))
    return labels.join(ids, ["grp", "label"], "left").select("key", F.coalesce("cluster_id", F.lit(schema.NOISE)).alias("cluster_id"))


def clustering_report(assigned: DataFrame) -> DataFrame:
    """(cluster_id, size) by size, largest first."""
    return assigned.groupBy("cluster_id").agg(F.count("*").alias("size")).orderBy(F.desc("size"), "cluster_id")
