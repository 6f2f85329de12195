"""Shards along a Hilbert curve over several metadata columns, so that a file spans little of any of them. DataFrame functions only."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.llm.common import staged, unstage

SHARDS = 8
#: Cells of a dimension: 2^BITS, with about equally many rows each.
BITS = 5
DIMENSIONS = ("lang", "source", "size")
#: The curve's table of turns has dimensions * 4^dimensions entries.
MOST_DIMENSIONS = 5
_PLACE = (1 << 33) - 1


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def _before(rows: DataFrame, order: list[str], weight: str | None) -> tuple[DataFrame, int]:
    """``rows`` in this order, written once, with ``before``, the weights of all rows ahead (their number without ``weight``), and the
    whole weight. Rows are sorted by range; the driver gets one sum per range, and no task sees more than its own. Ties are broken
    by the place where a row was read, so that a row repeated any number of times is still spread."""
    marked = rows.withColumn("_read", F.monotonically_increasing_id()).orderBy(*order, "_read").drop("_read")
    kept = staged(marked.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftrightunsigned("_at", 33).cast("int")
    mine = F.count("*") if weight is None else F.sum(weight)
    sums = kept.groupBy(part.alias("_part")).agg(mine.alias("w")).orderBy("_part").collect()  # a row per range
    starts, total = [], 0
    for row in sums:
        starts.append((row["_part"], total))
        total += row["w"]
    first = rows.sparkSession.createDataFrame(starts, "_part int, _start long")
    placed = kept.withColumn("_part", part).join(F.broadcast(first), "_part")
    if weight is None:
        ahead = F.col("_at").bitwiseAND(_PLACE)
    else:
        ahead = F.coalesce(F.sum(weight).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("before", F.col("_start") + ahead).drop("_part", "_start", "_at"), total


def quantisers(rows: DataFrame, dimensions: list[str], bits: int = BITS) -> dict[str, list[tuple[int, str | int]]]:
    """(cell, least value) of each dimension, ascending. A value's cell is 2^bits times the rows with a smaller value, divided by all
    rows: cells hold about equally many rows, and a value that many rows share has one cell. Exact counts of all rows, folded by value
    before they are sorted; at most 2^bits rows a dimension come to the driver."""
    text = [isinstance(rows.schema[d].dataType, T.StringType) for d in dimensions]
    keys = [
        F.struct(F.lit(i).alias("dim"), (F.col(d) if t else F.lit(None).cast("string")).alias("s"), (F.lit(None).cast("long") if t else F.col(d).cast("long")).alias("v"))
        for i, (d, t) in enumerate(zip(dimensions, text))
    ]
    counted = rows.select(F.explode(F.array(*keys)).alias("k")).groupBy("k.dim", "k.s", "k.v").agg(F.count("*").alias("n"))
    ahead, total = _before(counted, ["dim", "s", "v"], "n")
    each = max(1, total // len(dimensions))
    cell = F.floor((F.col("before") - F.col("dim") * each).cast("decimal(38,0)") * (1 << bits) / each).cast("int")
    least = ahead.groupBy("dim", cell.alias("cell")).agg(F.min(F.struct("s", "v")).alias("k")).collect()
    found: dict[str, list[tuple[int, str | int]]] = {d: [] for d in dimensions}
    for row in sorted(least, key=lambda r: (r["dim"], r["cell"])):
        found[dimensions[row["dim"]]].append((row["cell"], row["k"]["s"] if text[row["dim"]] else row["k"]["v"]))
    return found


def cell_of(value: Column, bounds: list[tuple[int, str | int]]) -> Column:
    """The cell of a value by its dimension's bounds."""
    found = F.lit(0)
    for cell, least in bounds[1:]:
        found = F.when(value >= F.lit(least), cell).otherwise(found)
    return found


def _turns(axes: int) -> tuple[list[int], list[int]]:
    """For each state of the curve and each corner of a cell, by state * 2^axes + corner: the corner's place on the curve, and the state
    inside that corner. A state is where the curve enters a cell and along which axis it leaves it; corners follow a Gray code."""
    corners = 1 << axes
    rotated = lambda x, k: (x << k | x >> (axes - k)) & (corners - 1)
    ones = lambda x: (~x & (x + 1)).bit_length() - 1  # noqa: E731  (trailing ones)
    place, after = [0] * (corners * axes * corners), [0] * (corners * axes * corners)
    for entry in range(corners):
        for axis in range(axes):
            for corner in range(corners):
                gray = rotated(corner ^ entry, (axes - axis - 1) % axes)
                w, shift = gray, gray >> 1
                while shift:
                    w, shift = w ^ shift, shift >> 1
                start = 0 if not w else (w - 1) // 2 * 2
                inner = entry ^ rotated(start ^ start >> 1, (axis + 1) % axes)
                along = 0 if not w else ones(w if w & 1 else w - 1) % axes
                at = (entry * axes + axis) * corners + corner
                place[at], after[at] = w, inner * axes + (axis + along + 1) % axes
    return place, after


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """The place of cells (integers below 2^bits, one per axis) on the Hilbert curve of that many dimensions: a fold from the highest bits
    to the lowest, which carries the curve's state."""
    axes = len(cells)
    place, after = (F.split(F.lit(",".join(map(str, t))), ",").cast("array<int>") for t in _turns(axes))  # constants, folded by the optimizer
    corner = lambda b: functools.reduce(Column.__add__, [F.shiftleft(F.shiftright(c, b).bitwiseAND(1), i) for i, c in enumerate(cells)])
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))

    def step(s: Column, c: Column) -> Column:
        at = s["state"] * (1 << axes) + c
        return F.struct(F.get(after, at).alias("state"), (F.shiftleft(s["index"], axes) + F.get(place, at)).alias("index"))

    return F.aggregate(F.array(*[corner(b) for b in range(bits - 1, -1, -1)]), start, step, lambda s: s["index"])


def shard(
    docs: DataFrame, shards: int = SHARDS, law: str = "rows", dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """(doc_id, size, text_crc32, dimensions as d0, d1, ..., curve, law, shard, slot) of every row, and with ``carry`` its columns as ``row``.

    Dimensions are columns of strings, integers or dates, or ``size`` (bytes of the text plus 1); a null string counts as empty, another null as
    the least value. Rows in the order of their cells on the Hilbert curve, then of their texts' checksums and ids, are cut into
    runs: with law ``rows`` counts of rows differ by one at most, with ``bytes`` each run ends where its share of all bytes does,
    so that sizes differ by two texts at most. Slots count from 0 in the curve's order. Equal rows are rows of their own, equal
    texts of equal metadata lie side by side, an empty table gives no row, and fewer rows than shards leave shards empty.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law: {law}")
    if not 2 <= len(dimensions) <= MOST_DIMENSIONS or bits * len(dimensions) > 62:
        raise ValueError(f"2 to {MOST_DIMENSIONS} dimensions, and below 63 bits in all")
    text = F.col(text_col)
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        *[(text_size(text) if d == "size" and d not in docs.columns else _value(docs, d)).alias(f"d{i}") for i, d in enumerate(dimensions)],
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    names = [f"d{i}" for i in range(len(dimensions))]
    rows = staged(own, "rows")
    bounds = quantisers(rows.select(names), names, bits)
    curved = rows.withColumn("curve", hilbert_index([cell_of(F.col(d), bounds[d]) for d in names], bits))
    weight = None if law == "rows" else "size"
    placed, total = _before(curved, ["curve", "text_crc32", "doc_id"], weight)
    unstage(rows)
    number = (F.col("before").cast("decimal(38,0)") * shards / max(1, total)).cast("double")
    if law == "rows":
        k = F.expr(f"cast(cast(before as decimal(38,0)) * {shards} div {max(1, total)} as int)")
        start = F.expr(f"cast((cast(shard as decimal(38,0)) * {total} + {shards - 1}) div {shards} as bigint)")
        found = placed.withColumn("shard", k).withColumn("slot", F.col("before") - start)
    else:
        found = placed.withColumn("shard", F.least(F.floor(number).cast("int"), F.lit(shards - 1)))
        found = _slots(found)
    return found.drop("before").withColumn("law", F.lit(law))


def _value(docs: DataFrame, name: str) -> Column:
    kind = docs.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(f"`{name}`"), F.lit(""))
    if isinstance(kind, T.DateType):
        return F.coalesce(F.unix_date(F.col(f"`{name}`")).cast("long"), F.lit(-(1 << 63)))
    if isinstance(kind, T.IntegralType):
        return F.coalesce(F.col(f"`{name}`").cast("long"), F.lit(-(1 << 63)))
    raise TypeError(f"{name} is no string, integer or date")


def _slots(placed: DataFrame) -> DataFrame:
    """Places inside each shard by the rows ahead, one range of the order per task."""
    ordered, _ = _before(placed.withColumnRenamed("before", "_bytes"), ["_bytes"], None)
    kept = staged(ordered, "placed")
    first = kept.groupBy("shard").agg(F.min("before").alias("_first"))  # a row per shard
    return kept.join(F.broadcast(first), "shard").withColumn("slot", F.col("before") - F.col("_first")).drop("_first", "_bytes")


def ranges(sharded: DataFrame, dimensions: int = len(DIMENSIONS)) -> DataFrame:
    """Per shard: rows, bytes, and the least and largest value of each dimension, which tell the shards that a filter can skip."""
    spans = [f(f"d{i}").alias(f"d{i}_{n}") for i in range(dimensions) for f, n in ((F.min, "least"), (F.max, "most"))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *spans)


def write_shards(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the rows of ``docs`` as Parquet, a folder ``_shard=<number>`` per shard, files in the curve's order with ``_slot``; returns ``ranges``.
    Options are those of ``shard``. Columns of ``docs`` that are called so are left out."""
    placed = staged(shard(docs, carry=True, **options), "sharded")
    inner = [f"row.`{c}`" for c in docs.columns if c not in ("_shard", "_slot")]
    placed.select(F.col("shard").alias("_shard"), F.col("slot").alias("_slot"), *inner).sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)
    return ranges(placed, len(options.get("dimensions", DIMENSIONS)))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return shard(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def _curve_sql(bits: int) -> str:
    """The curve over three cells x, y, z as SQL, two tables per bit: e is the corner where it enters, d the axis along which it leaves."""
    tables, last = ["start AS (SELECT *, 0 AS e, 0 AS d, 0::BIGINT AS curve FROM cells)"], "start"
    turned = lambda x, k: f"(((({x}) << (({k}) % 3)) | (({x}) >> (3 - ({k}) % 3))) & 7)"
    for bit in range(bits - 1, -1, -1):
        corner = f"xor(((x >> {bit}) & 1) + ((y >> {bit}) & 1) * 2 + ((z >> {bit}) & 1) * 4, e)::INT"
        tables.append(f"g{bit} AS (SELECT *, {turned(corner, '2 - d')} AS g FROM {last}), w{bit} AS (SELECT * EXCLUDE (g), xor(xor(g, g >> 1), g >> 2) AS w FROM g{bit})")
        inner = turned("CASE WHEN w IN (3, 4) THEN 3 WHEN w IN (5, 6) THEN 6 WHEN w = 7 THEN 5 ELSE 0 END", "d + 1")
        along = "CASE WHEN w IN (1, 2, 5, 6) THEN 1 WHEN w IN (3, 4) THEN 2 ELSE 0 END"
        tables.append(f"t{bit} AS (SELECT * EXCLUDE (w) REPLACE (xor(e, {inner}) AS e, (d + {along} + 1) % 3 AS d, curve * 8 + w AS curve) FROM w{bit})")
        last = f"t{bit}"
    return ",\n".join(tables) + f",\ncurved AS (SELECT * FROM {last})"


def _zero_bytes(value: int, n: int) -> int:
    """The checksum's register after ``n`` zero bytes."""
    for _ in range(8 * n):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


#: Hex digits of a stretch of text whose checksum is folded byte by byte; those of a text's stretches are combined.
_STRETCH = 512
_SHIFTED = "0"
for _bit in range(32):
    _SHIFTED = f"xor({_SHIFTED}, ((a >> {_bit}) & 1) * {_zero_bytes(1 << _bit, _STRETCH // 2)})"

#: Four bytes put before a text stand for the checksum's first register (all ones), and zeros before those change nothing.
OP12_SQL = f"""
WITH RECURSIVE poly(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM poly WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS t FROM poly WHERE k = 8),
d AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, strlen(coalesce(text, '')) + 1 AS size, '62F52692' || hex(encode(coalesce(text, ''))) AS h FROM documents
), padded AS (SELECT row_no, lpad(h, ((length(h) + {_STRETCH - 1}) // {_STRETCH} * {_STRETCH})::INT, '0') AS h FROM d),
stretches AS (SELECT row_no, j, h[j * {_STRETCH} + 1 : (j + 1) * {_STRETCH}] AS h FROM padded, unnest(range(length(h) // {_STRETCH})) u(j)),
folded AS (
  SELECT row_no, j, list_reduce(list_transform(range({_STRETCH // 2}), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT), lambda a, b: xor(t[xor(a, b) % 256 + 1], a >> 8), 0) AS r FROM stretches, tab
), sums AS (SELECT row_no, xor(list_reduce(list(r ORDER BY j), lambda a, b: xor({_SHIFTED}, b), 0), 4294967295) AS text_crc32 FROM folded GROUP BY row_no),
c AS (SELECT doc_id, lang, source, size, text_crc32 FROM d JOIN sums USING (row_no)
), q AS (SELECT count(*) AS n FROM d),
qx AS (SELECT lang, ((sum(count(*)) OVER (ORDER BY lang) - count(*)) * {1 << BITS} // (SELECT n FROM q))::BIGINT AS x FROM d GROUP BY lang),
qy AS (SELECT source, ((sum(count(*)) OVER (ORDER BY source) - count(*)) * {1 << BITS} // (SELECT n FROM q))::BIGINT AS y FROM d GROUP BY source),
qz AS (SELECT size, ((sum(count(*)) OVER (ORDER BY size) - count(*)) * {1 << BITS} // (SELECT n FROM q))::BIGINT AS z FROM d GROUP BY size),
cells AS (SELECT c.*, x, y, z FROM c JOIN qx USING (lang) JOIN qy USING (source) JOIN qz USING (size)),
{_curve_sql(BITS)},
ranked AS (SELECT *, row_number() OVER (ORDER BY curve, text_crc32, doc_id) - 1 AS r FROM curved)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (r * {SHARDS} // (SELECT n FROM q))::INT AS shard,
       (r - (r * {SHARDS} // (SELECT n FROM q) * (SELECT n FROM q) + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard, curve
FROM ranked
"""
