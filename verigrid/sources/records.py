"""Records of CSV files, read by splits even where fields hold line breaks (SRC01, SRC02).

Whether a line begins inside a quoted field depends on every quote before it. So each split of a
file first counts its own quotes; the parity of all earlier splits of the file (a prefix XOR) tells
how a split begins, and from there its lines are joined to records as they stream past. Only the
pieces of records that cross from one split into the next are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BOM = "﻿"
#: ``part``: 0 a whole record, 1 the last, open record of a split, 2 what a split's first lines add to an earlier record
PIECES = "file string, block bigint, first boolean, part int, value string"


def physical_lines(spark: SparkSession, path: str, line_sep: str, escape: str) -> DataFrame:
    """Lines in the order of their split, with the quotes each holds; ``split`` names the split."""
    value = F.col("value")
    # an escape takes the character behind it along; a doubled quote counts two either way
    counted = value if escape == '"' else F.regexp_replace(value, "(?s)" + _literal(escape) + ".", "")
    quotes = F.length(counted) - F.length(F.replace(counted, F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", line_sep).text(path)
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return lines.select(F.xxhash64(file, block).alias("split"), quotes.cast("bigint").alias("quotes"), file.alias("file"), block.alias("block"), "value")


def _literal(character: str) -> str:
    return "\\" + character if not character.isalnum() else character


def open_splits(lines: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Every split and whether it begins inside a quoted field: 9 bytes for each 128 MB or so of input."""
    per = lines.groupBy("split", "file", "block").agg((F.sum("quotes") % 2).alias("odd"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    table = per.select("split", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("boolean").alias("open")).toArrow()
    split, inside = table.column("split").to_numpy(), table.column("open").to_numpy()
    order = np.argsort(split)
    return split[order], inside[order]


def records(spark: SparkSession, path: str, line_sep: str = "\n", multi_line: bool = False, escape: str = '"') -> DataFrame:
    """``file``, ``first`` (the first record of its file) and ``value`` of every record.

    A record is a line, or, with ``multi_line``, as many lines as its quotes hold together;
    ``line_sep`` stays inside it. No quote is judged here.
    """
    lines = physical_lines(spark, path, line_sep, escape)
    known = open_splits(lines) if multi_line else None

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, inside, at_start, held, head = None, False, False, [], False
        where = ("", 0)

        def piece(part: int, first: bool) -> pa.RecordBatch:
            row = [[where[0]], [where[1]], [first and part != 2], [part], [line_sep.join(held)]]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], ["file", "block", "first", "part", "value"])

        for whole in batches:
            split, ends = whole.column(0).to_numpy(), [0]
            if whole.num_rows:
                ends = [0, *(np.flatnonzero(split[1:] != split[:-1]) + 1).tolist(), whole.num_rows]
            for a, b in zip(ends, ends[1:], strict=False):
                batch = whole.slice(a, b - a)
                if split[a] != last:
                    if held:
                        yield piece(2 if head else 1, at_start)
                    last, held, where = split[a], [], (batch.column(2)[0].as_py(), batch.column(3)[0].as_py())
                    at_start = where[1] == 0
                    inside = False
                    if known is not None:
                        i = int(np.searchsorted(known[0], last))
                        if i == known[0].size or known[0][i] != last:
                            raise RuntimeError(f"{where[0]} was split in another way the second time")
                        inside = bool(known[1][i])
                    head = inside
                quotes = batch.column(1).to_numpy() if known is not None else np.zeros(b - a, np.int64)
                after = (np.cumsum(quotes) + inside) % 2 == 1
                ends_here = np.flatnonzero(~after)  # lines with which a record is complete
                texts, at = batch.column(4), 0
                if ends_here.size and (held or head):  # the record that was begun before
                    at = int(ends_here[0]) + 1
                    held += texts.slice(0, at).to_pylist()
                    yield piece(2 if head else 0, at_start)
                    held, head, at_start, ends_here = [], False, False, ends_here[1:]
                if ends_here.size:
                    n, size = ends_here.size, int(ends_here[-1]) + 1 - at
                    whole_records = texts.slice(at, size)
                    if n < size:  # some have several lines
                        offsets = pa.array(np.concatenate([[0], ends_here + 1 - at]), pa.int32())
                        whole_records = pc.binary_join(pa.ListArray.from_arrays(offsets, whole_records), line_sep)
                    first = np.zeros(n, bool)
                    first[0], at_start = at_start, False
                    at += size
                    columns = [batch.column(2).slice(0, n), batch.column(3).slice(0, n), pa.array(first), pa.array(np.zeros(n, np.int32)), whole_records]
                    yield pa.RecordBatch.from_arrays(columns, ["file", "block", "first", "part", "value"])
                held += texts.slice(at).to_pylist()
                inside = bool(after[-1])
        if held:
            yield piece(2 if head else 1, at_start)

    pieces = lines.mapInArrow(join, PIECES)
    if not multi_line:
        return pieces.select("file", "first", "value")
    # an open record, then the splits that go on with it; of these, a piece per split
    part = pieces.filter("part > 0")
    begun = W.partitionBy("file").orderBy("block", F.desc("part")).rowsBetween(W.unboundedPreceding, 0)
    part = part.withColumn("number", F.count_if(F.col("part") == 1).over(begun))
    texts = F.array_sort(F.collect_list(F.struct("block", F.when(F.col("part") == 2, 0).otherwise(1).alias("late"), "value")))
    crossing = part.groupBy("file", "number").agg(F.bool_or("first").alias("first"), texts.alias("t"))
    crossing = crossing.select("file", "first", F.array_join(F.transform("t", lambda x: x["value"]), line_sep).alias("value"))
    return pieces.filter("part = 0").select("file", "first", "value").unionByName(crossing)


def strict_record(escape: str = '"') -> str:
    """A pattern of well-formed records, linear in their length.

    A field is quoted, with quotes doubled or escaped, and ends at a comma or the record's end; or
    it is bare, does not begin with a quote and holds no line break; or it is empty. Possessive
    repeats keep the automaton from ever going back.
    """
    e = _literal(escape)
    inner = '[^"]*+(?:""[^"]*+)*+' if escape == '"' else f'[^"{e}]*+(?:{e}.[^"{e}]*+)*+'
    field = f'(?:"{inner}"(?=,|\\z)|[^",\\r\\n][^,\\r\\n]*+|(?=,|\\z))'
    return f"(?s)\\A{field}(?:,{field})*+\\z"


def parse_records(found: DataFrame, names: Sequence[str], escape: str = '"') -> DataFrame:
    """The fields of ``records`` as texts; what breaks a rule stops the job and is told.

    The first record of each file must be the header (a byte order mark before it is taken off)
    and is dropped. Carriage returns at the end of a record are taken off. Bad quoting, a line
    break outside quotes and another number of fields stop the job. A repeated header is a data
    row; ``file_records`` counts it. An empty field is an empty text.
    """
    text = F.regexp_replace(F.when(F.col("first"), F.regexp_replace("value", f"^{BOM}", "")).otherwise(F.col("value")), "\\r+$", "")
    kind = ", ".join(f"`{n}` string" for n in names)
    stop = lambda why: F.raise_error(F.concat(F.lit(f"{why}: "), F.substring("text", 1, 200), F.lit(" in "), F.col("file")))
    options = {"mode": "FAILFAST", "escape": escape, "maxCharsPerColumn": "-1", "maxColumns": str(len(names) + 1), "multiLine": "true"}
    strict = F.when(F.col("text").rlike(strict_record(escape)), F.col("text")).otherwise(stop("no well-formed record"))
    parsed = found.select("file", "first", text.alias("text")).select("file", "first", "text", F.from_csv(strict, kind, options).alias("r"))
    fields = [F.coalesce(F.col("r")[n], F.lit("")) for n in names]
    header = F.lit(True)
    for name, value in zip(names, fields, strict=True):
        header = header & (value == name)
    kept = parsed.filter(F.when(~F.col("first"), True).when(header, False).otherwise(stop("the first record is not the header").cast("boolean")))
    return kept.select(*[v.alias(n) for n, v in zip(names, fields, strict=True)])


def file_records(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of record and header counts and files without exactly one header; no field is parsed."""
    plain = F.regexp_replace(F.regexp_replace("value", f"^{BOM}", ""), "\\r+$", "")
    header = plain.isin(",".join(names), ",".join(f'"{n}"' for n in names))
    files = found.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.count_if(header).alias("header_lines"))
    return files.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
        F.coalesce(F.sum("header_lines"), F.lit(0)).alias("header_lines"),
        F.count_if(F.col("header_lines") != 1).alias("header_faults"),
    )


def contract_records(spark: SparkSession, path: str, contract) -> DataFrame:
    return records(spark, path, contract.line_sep, contract.multi_line, contract.escape)
