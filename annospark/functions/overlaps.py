"""Overlaps of boxes: candidates by a grid of levels, for all images of a batch together."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Boxes of both sides whose candidates are sought together, about.
_BATCH = 1 << 18
#: Pairs of boxes of an image up to which all of them are compared.
_FEW = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _boxes(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(boxes in a row, their four numbers as floats, their structs) of an array of lists of structs with a bbox of four numbers. A missing
    number, or a list of another length, makes a box NaN."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    bbox = flat.field("bbox") if len(flat) else pa.array([], pa.list_(pa.int32()))
    lengths = pc.fill_null(pc.list_value_length(bbox), 0).to_numpy(zero_copy_only=False)
    corners = np.full((len(flat), 4), np.nan)
    full = np.flatnonzero(lengths >= 4)
    if len(full):
        values = bbox.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.cumsum(lengths) - lengths
        corners[full] = values[starts[full][:, None] + np.arange(4)]
    return counts, corners, flat


def _labels(flat: pa.Array, other: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    both = pa.concat_arrays([x.field("label") if len(x) else pa.array([], pa.string()) for x in (flat, other)]).dictionary_encode(null_encoding="encode").indices.to_numpy()
    return both[: len(flat)], both[len(flat) :]


def _cells(image: np.ndarray, box: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, hashes of the cells) that boxes of at most a cell's size touch: up to four cells each."""
    low, high = np.floor(box[:, :2] / 2.0**level), np.floor(box[:, 2:] / 2.0**level)
    rows, keys = [], []
    for right in (0, 1):
        for down in (0, 1):
            has = np.flatnonzero((low[:, 0] + right <= high[:, 0]) & (low[:, 1] + down <= high[:, 1]))
            rows.append(has)
            key = image[has].astype(np.uint64)
            for axis, by in ((0, right), (1, down)):
                key = (key * _MIX) ^ (low[has, axis] + by).astype(np.int64).view(np.uint64)
            keys.append(key * _MIX)
    return np.concatenate(rows), np.concatenate(keys)


def _meetings(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal keys in a and b, all pairs of them."""
    order = np.argsort(b, kind="stable")
    found = b[order]
    first, last = np.searchsorted(found, a, "left"), np.searchsorted(found, a, "right")
    n = last - first
    left = np.repeat(np.arange(len(a)), n)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return left, order[np.repeat(first, n) + inner]


def overlapping(image_a: np.ndarray, a: np.ndarray, image_b: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of boxes of the same image that share an area, as places in both, each pair once.

    A box belongs to the level whose cells (squares of 2^level) are the smallest that it doesn't exceed, so it touches four cells there at most.
    On each level in use, the boxes of that level from one side meet those of that or lower levels from the other in their cells. The work
    is in proportion to boxes times levels, plus pairs of which the smaller lies near the larger.
    """
    size = lambda x: np.maximum(x[:, 2] - x[:, 0], x[:, 3] - x[:, 1])
    solid = lambda x: np.isfinite(x).all(axis=1) & (x[:, 2] > x[:, 0]) & (x[:, 3] > x[:, 1])
    left, right = np.flatnonzero(solid(a)), np.flatnonzero(solid(b))
    level_a, level_b = (np.ceil(np.log2(size(x[k]))).astype(np.int64) for x, k in ((a, left), (b, right)))
    pairs = []
    for level in np.unique(np.concatenate([level_a, level_b])).tolist():
        for mine, theirs in ((level_a == level, level_b <= level), (level_a < level, level_b == level)):
            x, y = left[mine], right[theirs]
            if not len(x) or not len(y):
                continue
            row_x, key_x = _cells(image_a[x], a[x], level)
            row_y, key_y = _cells(image_b[y], b[y], level)
            i, j = _meetings(key_x, key_y)
            x, y, cell = x[row_x[i]], y[row_y[j]], key_x[i]
            corner = np.maximum(a[x, :2], b[y, :2])  # where the shared area begins: the pair counts in that cell only
            meet = (image_a[x] == image_b[y]) & (corner < np.minimum(a[x, 2:], b[y, 2:])).all(axis=1)
            x, y, cell, corner = x[meet], y[meet], cell[meet], corner[meet]
            own = _cells(image_a[x], np.concatenate([corner, corner], axis=1), level)[1]
            pairs.append((x[own == cell], y[own == cell]))
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def ious(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of boxes side by side that share an area."""
    width = np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0])
    height = np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1])
    inter = np.maximum(width, 0.0) * np.maximum(height, 0.0)
    union = (a[:, 2] - a[:, 0]) * (a[:, 3] - a[:, 1]) + (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1]) - inter
    return inter / union


def _parts(n: np.ndarray) -> list[tuple[int, int]]:
    """Runs of rows with about ``_BATCH`` boxes."""
    cut = np.flatnonzero(np.diff(np.cumsum(n) // _BATCH)) + 1
    edges = [0, *cut.tolist(), len(n)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def _near(n: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``overlapping`` for boxes in a row, n and m to an image. Images of few pairs are compared box by box, others by the grid."""
    image_a, image_b = np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)
    few = n * m <= _FEW
    each = np.where(few[image_a], m[image_a], 0)
    x = np.repeat(np.arange(len(a)), each)
    y = np.arange(len(x)) - np.repeat(np.cumsum(each) - each, each) + (np.cumsum(m) - m)[image_a[x]]
    meet = (np.maximum(a[x, :2], b[y, :2]) < np.minimum(a[x, 2:], b[y, 2:])).all(axis=1) & np.isfinite(a).all(axis=1)[x] & np.isfinite(b).all(axis=1)[y]
    x, y = x[meet], y[meet]
    if few.all():
        return x, y
    left, right = np.flatnonzero(~few[image_a]), np.flatnonzero(~few[image_b])
    i, j = overlapping(image_a[left], a[left], image_b[right], b[right])
    return np.concatenate([x, left[i]]), np.concatenate([y, right[j]])


def _taken(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which candidate pairs match, of detections x in turn with their best box y first. Who has a box to itself that is its best takes it
    without a look at the others; the rest goes pair by pair."""
    best = np.diff(x, prepend=-1) != 0
    taken = best & (np.bincount(y, minlength=1)[y] == 1)
    rest = np.flatnonzero(~np.isin(x, x[taken]))
    used, last = set(), -1
    for at, i, j in zip(rest.tolist(), x[rest].tolist(), y[rest].tolist()):
        if i != last and j not in used:
            used.add(j)
            last = i
            taken[at] = True
    return taken


def _greedy(dets: pa.Array, gts: pa.Array, threshold: float, same_label: bool, confidences: tuple[float, ...] | None = None) -> pa.Array:
    """IoUs of matched pairs of each image; with ``confidences``, for each of them (confidence, detections that reach it, their IoUs)."""
    out = []
    sizes = [pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False) for x in (dets, gts)]
    for start, end in _parts(sizes[0] + sizes[1]):
        n, a, left = _boxes(dets.slice(start, end - start))
        m, b, right = _boxes(gts.slice(start, end - start))
        image = np.repeat(np.arange(len(n)), n)
        x, y = _near(n, a, m, b)
        v = ious(a[x], b[y])
        keep = (v > 0) & (v >= threshold)
        if same_label:
            label_a, label_b = _labels(left, right)
            keep &= label_a[x] == label_b[y]
        x, y, v = x[keep], y[keep], v[keep]
        order = np.lexsort((y, -v, x))  # detections in turn, each with its best candidate first
        x, y, v = x[order], y[order], v[order]
        own = None
        if confidences is not None and len(left):
            own = pc.fill_null(left.field("confidence"), 0.0).to_numpy(zero_copy_only=False).astype(np.float64)
        counts, rows, values = [], [], []  # per confidence: detections, and the image and IoU of each match
        for least in confidences or (None,):
            reach = np.ones(len(image), bool) if own is None else (own >= least) | np.isnan(own)  # NaN is above all, as in Spark
            at = np.flatnonzero(reach[x])
            at = at[_taken(x[at], y[at])]
            counts.append(np.bincount(image[reach], minlength=len(n)))
            rows.append(image[x[at]])
            values.append(v[at])
        k = len(counts)
        place = np.concatenate([r * k + i for i, r in enumerate(rows)])  # images in turn, and their confidences in turn
        matched = np.concatenate(values)[np.argsort(place, kind="stable")]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(n) * k))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(matched))
        if confidences is not None:
            steps = pa.array(np.tile(np.array(confidences, np.float64), len(n)))
            found = pa.array(np.stack(counts, axis=1).reshape(-1).astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array((np.arange(len(n) + 1) * k).astype(np.int32)), pa.StructArray.from_arrays([steps, found, lists], ["threshold", "num_det", "ious"]))
        out.append(lists)
    kind = pa.list_(pa.float64())
    return pa.concat_arrays(out) if out else pa.array([], kind if confidences is None else pa.list_(pa.struct([("threshold", pa.float64()), ("num_det", pa.int32()), ("ious", kind)])))


def _best(first: pa.Array, second: pa.Array) -> pa.Array:
    out = []
    sizes = [pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False) for x in (first, second)]
    for start, end in _parts(sizes[0] + sizes[1]):
        n, a, _ = _boxes(first.slice(start, end - start))
        m, b, _ = _boxes(second.slice(start, end - start))
        x, y = _near(n, a, m, b)
        best = np.zeros(len(a))
        np.maximum.at(best, x, ious(a[x], b[y]))
        out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(best)))
    return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.float64()))


def greedy_ious(dets: Column, gts: Column, threshold: float, same_label: bool) -> Column:
    """IoUs of matched pairs: each detection in turn takes the free ground-truth box with the largest IoU, of at least ``threshold`` and above
    0; of equal ones the first. dets and gts: arrays of structs (bbox, label); with ``same_label`` only equal labels match."""

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return _greedy(left, right, threshold, same_label)

    return F.arrow_udf(run, "array<double>")(dets, gts)


def sweep_ious(dets: Column, gts: Column, confidences: tuple[float, ...], threshold: float, same_label: bool) -> Column:
    """For each least confidence in turn, (threshold, num_det, ious): the detections that reach it, and ``greedy_ious`` of them. Missing
    confidence counts as 0. Overlaps are looked for once. dets: array of structs (bbox, label, confidence)."""

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return _greedy(left, right, threshold, same_label, confidences)

    return F.arrow_udf(run, "array<struct<threshold:double,num_det:int,ious:array<double>>>")(dets, gts)


def best_ious(first: Column, second: Column) -> Column:
    """For each box of the first array, its largest IoU with any of the second; 0 without overlap."""

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return _best(left, right)

    return F.arrow_udf(run, "array<double>")(first, second)
