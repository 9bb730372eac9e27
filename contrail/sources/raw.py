"""Bronze (raw) sources: API payloads landed as JSON or Parquet (S1-S5),
dictionaries (S10, S11).

What a file holds decides how it is read, never its name beyond the extension:
a ``.json`` file is one document or one document a line, found by parsing it to
a variant.  Contents and Parquet footers are read in the executors; the driver
sees one row per folder and schema, the files of a folder whose files differ, and
the listing that any Spark scan needs.
"""

from __future__ import annotations

import functools
import itertools
import json
import logging
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators.align import align_union

_log = logging.getLogger(__name__)

# Markers of an API error payload.
ERROR_FIELDS = ("error", "error.message", "error.code")
MONTH_LIMIT = "month_limit_exceeded"

# Ingest order of a landed record: its file's path (snapshots are filed by
# time, so paths sort by time), then its place in the file.
FILE_ORDER = ["file_path", "record_pos"]


def _files(spark: SparkSession, prefix: str | list[str], pattern: str | None = None) -> DataFrame | None:
    """All files below ``prefix`` (binary source; unused columns are pruned);
    None if there is no such folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        return reader.load(prefix)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_files(spark: SparkSession, prefix: str | list[str]) -> DataFrame:
    """Recursive listing (path, length, modificationTime) without contents."""
    files = _files(spark, prefix)
    if files is None:
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    return files.select("path", "length", "modificationTime")


# ---- JSON payloads (S1, S2) --------------------------------------------

def _held(text: Column) -> Column:
    """The JSON values that ``text`` holds, as a variant list; null if it is no JSON.  (The
    parser by itself stops after the first value.)"""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def _only(held: Column) -> Column:
    """The one value of a list, null if it holds none, or more."""
    return F.when(F.try_variant_get(held, "$[1]", "variant").isNull(), F.try_variant_get(held, "$[0]", "variant"))


def _parsed(text: Column) -> Column:
    """The one JSON value that ``text`` holds, as a variant; null if it holds none, or
    more."""
    return _only(_held(text))


def _kind(v: Column) -> Column:
    """Top-level type of a variant: OBJECT, ARRAY, STRING, BIGINT, ..."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _accepted(v: Column, weather: Column | bool = False, kind: Column | None = None) -> Column:
    """S2 on a parsed payload (null: unparsable, not accepted) of the top-level type ``kind``."""
    key = lambda name: F.try_variant_get(v, f"$['{name}']", "variant")
    cod = key("cod")
    text = F.when(_kind(cod) == "STRING", F.try_variant_get(v, "$.cod", "string"))
    error = key("error").isNotNull() | key("error.message").isNotNull() | \
        F.coalesce(text == MONTH_LIMIT, F.lit(False))
    number = F.when(_kind(cod).isin("BIGINT", "DECIMAL", "DOUBLE"), F.try_variant_get(v, "$.cod", "double"))
    bad_cod = cod.isNotNull() & (_kind(cod) != "VOID") & F.coalesce(number != 200, F.lit(True))
    weather = F.lit(weather) if isinstance(weather, bool) else weather
    is_object = (_kind(v) if kind is None else kind) == "OBJECT"
    return F.coalesce(~(is_object & (error | (weather & bad_cod))) & (~weather | is_object), F.lit(False))


def payload_ok(body: str = "body", weather: bool = False) -> Column:
    """False for API error payloads, and for text that is no JSON.

    An object with the key ``error`` or ``error.message`` (whatever its value)
    or with ``cod`` the text ``month_limit_exceeded`` is an error.  A weather
    payload is an object without ``cod``, with a null ``cod`` or the number 200.
    """
    return _accepted(_parsed(F.col(body)), weather)


def _records(v: Column, kind: Column | None = None) -> Column:
    """The records of a payload (of the top-level type ``kind``) as variants: the
    items of a list, one object, or those of its ``response``.  Nothing, null and empty
    values hold none."""
    kind = _kind(v) if kind is None else kind
    response = F.when(kind == "OBJECT", F.try_variant_get(v, "$.response", "variant"))
    full = lambda x: (_kind(x) == "OBJECT") & (F.schema_of_variant(x) != "OBJECT<>")
    items = lambda x: F.filter(F.try_variant_get(x, "$", "array<variant>"), lambda r: _kind(r) == "OBJECT")
    held = lambda x, of: F.when(of == "ARRAY", items(x)).when(full(x), F.array(x))
    return F.when(response.isNull(), held(v, kind)).otherwise(held(response, _kind(response)))


def _inferred(rows: DataFrame, v: str) -> T.StructType:
    """The schema of the objects in column ``v``, found in one aggregation; a
    field of mixed types is text, decimals are doubles."""
    found = rows.agg(F.schema_of_variant_agg(v)).first()[0]
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return T.StructType([])
    ddl = re.sub(r"\bDECIMAL\(\d+,\d+\)", "DOUBLE", found.replace("OBJECT<", "STRUCT<"))
    ddl = re.sub(r"(?<=: )(VARIANT|VOID)\b", "STRING", ddl)
    return T._parse_datatype_string(ddl)


def _fields(v: str, schema: T.StructType, flat: bool) -> list[Column]:
    """Typed columns of a variant object; with ``flat`` nested objects become
    ``a.b`` columns (P6).  A value that does not fit its type is null."""
    out = []

    def walk(fields, path: str, name: str):
        for f in fields:
            at, label = f"{path}['{f.name}']", f"{name}{f.name}"
            if flat and isinstance(f.dataType, T.StructType):
                walk(f.dataType.fields, at, f"{label}.")
            else:
                out.append(F.try_variant_get(F.col(v), at, f.dataType.simpleString()).alias(label))

    walk(schema.fields, "$", "")
    return out


def parse_records(df: DataFrame, record_schema: T.StructType | None = None, body: str = "body",
                  keep: list[str] | None = None) -> DataFrame:
    """S1 (schedules/flights): payload -> one row per record, with
    ``record_pos``, its place in the payload.  Without a schema it is found."""
    keep = list(keep or [])
    rows = df.select(*keep, F.posexplode(_records(_parsed(F.col(body)))).alias("record_pos", "__r"))
    schema = record_schema if record_schema is not None else _inferred(rows, "__r")
    return rows.select(*keep, "record_pos", *_fields("__r", schema, flat=False))


def parse_weather(df: DataFrame, record_schema: T.StructType | None = None, body: str = "body",
                  keep: list[str] | None = None) -> DataFrame:
    """S1 (weather): the whole payload is one record, flattened to ``a.b``
    columns (P6)."""
    keep = list(keep or [])
    rows = df.select(*keep, _parsed(F.col(body)).alias("__r"))
    schema = record_schema if record_schema is not None else _inferred(rows, "__r")
    return rows.select(*keep, *_fields("__r", schema, flat=True))


class _Cutter:
    """Cuts the documents of a text, which comes in pieces, into documents of about
    ``size`` characters with the same records in the same order: a list into lists, an
    object whose ``response`` is a list into objects with its other members and a part
    of that list.  One record is decoded at a time, and text behind it is let go.
    ValueError where the text is no JSON."""

    def __init__(self, pieces: Iterable[str], size: int):
        self.text, self.pieces, self.size = "", iter(pieces), size
        self.decode = json.JSONDecoder(parse_constant=self._refuse).raw_decode
        self.blank = re.compile(r"[ \t\r\n]*")

    @staticmethod
    def _refuse(what):
        raise ValueError(f"no JSON: {what}")

    def more(self) -> bool:
        piece = next(self.pieces, None)
        self.text += piece or ""
        return piece is not None

    def behind(self, at: int) -> int:
        end = self.blank.match(self.text, at).end()
        while end == len(self.text) and self.more():
            end = self.blank.match(self.text, end).end()
        return end

    def value(self, at: int):
        """The value at ``at``, and the place behind it."""
        while True:
            try:
                found, end = self.decode(self.text, at)
                if end < len(self.text) or not self.more():   # a number may go on
                    return found, end
            except json.JSONDecodeError:
                if not self.more():
                    raise

    def take(self, mark: str, at: int) -> int:
        at = self.behind(at)
        return self.behind(at + 1) if self.text[at:at + 1] == mark else self._refuse(f"no {mark}")

    def documents(self) -> Iterator[str]:
        at = self.behind(0)
        while at < len(self.text):
            cut = {"[": self.list, "{": self.object}.get(self.text[at], self.other)
            found, at = cut(at)
            yield from found
            at = self.behind(at)
            self.text, at = self.text[at:], 0

    def other(self, at: int) -> tuple[list[str], int]:
        end = self.value(at)[1]
        return [self.text[at:end]], end

    def list(self, at: int) -> tuple[list[str], int]:
        out, held, length = [], [], 0
        at = self.take("[", at)
        more = self.text[at:at + 1] != "]"
        while more:
            (value,), end = self.other(at)
            held.append(value)
            length += len(value)
            if length >= self.size:
                out.append("[" + ",".join(held) + "]")
                held, length = [], 0
                self.text, end = self.text[end:], 0
            at = self.behind(end)
            more = self.text[at:at + 1] == ","
            at = self.take(",", at) if more else at
        end = self.take("]", at)
        return out + (["[" + ",".join(held) + "]"] if held or not out else []), end

    def object(self, at: int) -> tuple[list[str], int]:
        members, lists = [], None
        at = self.take("{", at)
        more = self.text[at:at + 1] != "}"
        while more:
            key, end = self.value(at)
            if not isinstance(key, str):
                self._refuse("no key")
            at = self.take(":", end)
            if key == "response" and self.text[at:at + 1] == "[":
                lists, end = self.list(at)
            else:
                (value,), end = self.other(at)
                members.append(f"{json.dumps(key)}:{value}")
            at = self.behind(end)
            more = self.text[at:at + 1] == ","
            at = self.take(",", at) if more else at
        end = self.take("}", at)
        if lists is None:
            return ["{" + ",".join(members) + "}"], end
        return ["{" + ",".join([*members, f'"response":{x}']) + "}" for x in lists], end


#: Files beyond this many bytes are cut before they are parsed: a variant, the parsed
#: form of a document, holds 128 MB at most, about three bytes for one of text.
LARGE_JSON, PART_CHARS = 32 << 20, 4 << 20
#: Of a record's place these bits number the records of a document, of which 32 MB of
#: text holds fewer than 12 million; the bits above them number the documents of a file.
RECORD_BITS = 24


def _packed(batches: Iterator) -> Iterator:
    """Texts between commas (file_path, block, value), in order of the file within a
    block -> the same, some MB of them joined, numbered as ``n``."""
    import pyarrow as pa

    def row(key, n, held):
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([n], pa.int64()),
                                           pa.array([",".join(held)])], names=["file_path", "block", "n", "text"])

    key, n, held, size = None, 0, [], 0
    for batch in batches:
        for *here, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if held and (here != key or size >= PART_CHARS):
                yield row(key, n, held)
                held, size, n = [], 0, n + 1
            key = here
            held.append(text)
            size += len(text)
    if held:
        yield row(key, n, held)


def _cut_files(batches: Iterator) -> Iterator:
    """(file_path, text) in order -> (file_path, first, part): the parts of a file's
    documents, with their numbers; a null part where the text is no JSON."""
    import pyarrow as pa

    def row(path, n, part):
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int32()), pa.array([part], pa.string())],
                                          names=["file_path", "first", "part"])

    rows = (pair for batch in batches for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    for path, mine in itertools.groupby(rows, key=lambda r: r[0]):
        pieces = (text if i == 0 else "," + text for i, (_, text) in enumerate(mine))
        try:
            for n, part in enumerate(_Cutter(pieces, PART_CHARS).documents()):
                yield row(path, n, part)
        except (ValueError, RecursionError):
            yield row(path, 0, None)
        for _ in pieces:   # the rest of a file that was given up
            pass


def _numbered(batches: Iterator) -> Iterator:
    """Lines (file_path, block, value) in order of the file within a block -> (file_path,
    first, part): each with its number, by which a file's lines sort.  A line that is not
    blank has two bytes at least, so the numbers of a block, which start at its place in
    the file, end before those of the next."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block = batch.column(0), batch.column(1).to_numpy()
        other = (block[1:] != block[:-1]) | pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(other) + 1])
        index = np.arange(batch.num_rows) - np.repeat(starts, np.diff(starts, append=batch.num_rows))
        if (path[0].as_py(), block[0]) == last:
            index[:starts[1] if len(starts) > 1 else None] += seen
        last, seen = (path[-1].as_py(), block[-1]), int(index[-1]) + 1
        yield pa.RecordBatch.from_arrays([path, pa.array(block + index, pa.int64()), batch.column(2)],
                                         names=["file_path", "first", "part"])


def _json_files(spark: SparkSession):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")


def _has_large(spark: SparkSession, paths: str | list[str]) -> bool:
    listed = _files(spark, paths, "*.json")
    return listed is not None and not listed.where(F.col("length") > LARGE_JSON).isEmpty()


def _has_documents(spark: SparkSession, paths: str | list[str]) -> bool:
    """Some ``.json`` file below ``paths`` is not blank."""
    size = F.col("_metadata.file_size")
    if not _json_files(spark).text(paths, wholetext=True).where(size <= LARGE_JSON).where("trim(value) != ''").isEmpty():
        return True
    return _has_large(spark, paths) and not _json_files(spark).option("lineSep", ",").text(paths) \
        .where(size > LARGE_JSON).where("trim(value) != ''").isEmpty()


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines of the large files, read in splits: file_path, size, block, value.  Of a
    line of ``PART_CHARS`` bytes or more the reader gives no more than about that, or nothing."""
    return _json_files(spark).option("lineSep", "\n").option("mapreduce.input.linerecordreader.line.maxlength", PART_CHARS) \
        .text(paths).where(F.col("_metadata.file_size") > LARGE_JSON).select(
            F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("block"), "value")


def _line_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The large files that hold one document a line, and no line that the reader cuts or
    leaves out."""
    length = F.octet_length("value")
    lines = _lines(spark, paths).select("file_path", "size", length.alias("bytes"),
                                        F.when(length < PART_CHARS, _held(F.col("value"))).alias("held"))
    none_or_one = F.col("held").isNotNull() & F.try_variant_get("held", "$[1]", "variant").isNull()
    found = lines.groupBy("file_path", "size").agg(
        F.sum(F.col("bytes").cast("long") + 1).alias("read"),
        F.bool_and(none_or_one).alias("parsed"))
    whole = F.col("parsed") & (F.col("size") - F.col("read") <= 3)   # a byte order mark
    return [r[0] for r in found.where(whole).select("file_path").collect()]


def json_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every ``.json`` file below ``paths``: ``file_path`` and its documents as an
    array of variants, with the number ``first`` of the first; null where the file is
    neither one JSON document nor one a line.

    A snapshot is read by one task.  A file over ``LARGE_JSON`` bytes is read in splits:
    by its lines, each a row of its own, where every line is a document (one scan more
    tells).  Any other is read as the texts between its commas; one task puts them in
    order and cuts the documents into parts with the same records, each in a row of its
    own, of which it holds one object's ``response`` at most.  Should the file turn out
    to be no JSON, the documents before that place stand, and a row of null documents
    names it."""
    files = _json_files(spark)
    path, size = F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size")
    bodies = files.text(paths, wholetext=True).where(size <= LARGE_JSON).where("trim(value) != ''")
    # a step a value that is used more than once, so that it is parsed once
    bodies = bodies.select(path, "value", _held(F.col("value")).alias("held"))
    bodies = bodies.select("file_path", "value", _only(F.col("held")).alias("one"))
    texts = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
    lines = F.transform(F.transform(texts, _held), _only)
    bodies = bodies.select("file_path", "one", F.when(F.col("one").isNull(), lines).alias("lines"))
    whole = F.when(F.col("one").isNotNull(), F.array("one")).when(
        ~F.exists("lines", lambda x: x.isNull()), F.col("lines"))
    small = bodies.select("file_path", F.lit(0).cast("long").alias("first"), whole.alias("documents"))
    if not _has_large(spark, paths):
        return small
    by_line = _line_files(spark, paths)
    lined = F.col("file_path").isin(by_line)
    single = _lines(spark, paths).where(lined & ~F.trim("value").isin("", "\r")) \
        .select("file_path", "block", "value").mapInArrow(_numbered, "file_path string, first long, part string")
    between = files.option("lineSep", ",").text(paths).where(size > LARGE_JSON).select(
        path, F.col("_metadata.file_block_start").alias("block"), "value").where(~lined)
    packed = between.mapInArrow(_packed, "file_path string, block long, n long, text string")
    parts = packed.repartition("file_path").sortWithinPartitions("file_path", "block", "n") \
        .select("file_path", "text").mapInArrow(_cut_files, "file_path string, first int, part string")
    for part, known in ((single, F.lit(True)), (parts, F.col("one").isNotNull())):   # blank lines hold no document
        one = part.select("file_path", F.col("first").cast("long").alias("first"), _held(F.col("part")).alias("held")) \
            .select("file_path", "first", _only(F.col("held")).alias("one"))
        small = small.unionByName(one.select(
            "file_path", "first", F.when(known, F.array_compact(F.array("one"))).alias("documents")))
    return small


class Unreadable:
    """What a scan leaves out because it cannot be read, counted by the scan itself:
    :meth:`count` is known once its rows have been computed."""

    def __init__(self) -> None:
        self.footers, self._texts = 0, None

    def watch(self, docs: DataFrame) -> DataFrame:
        self._texts = Observation()
        broken = F.collect_set(F.when(F.col("documents").isNull(), F.col("file_path")))
        return docs.observe(self._texts, F.size(broken).alias("n"))

    def count(self) -> int:
        return self.footers + (self._texts.get["n"] if self._texts else 0)


def read_raw_json(spark: SparkSession, paths: str | list[str], record_schema: T.StructType | None = None,
                  weather: bool = False, unreadable: Unreadable | None = None) -> DataFrame:
    """S1 + S2 over files: parse, drop error payloads, explode records, with the
    columns of :data:`FILE_ORDER`."""
    docs = json_documents(spark, paths)
    if unreadable is not None:
        docs = unreadable.watch(docs)
    # outer, with a filter of its own: the one that Spark would infer parses everything again
    docs = docs.select("file_path", "first", F.posexplode_outer("documents").alias("__n", "__v")) \
        .where("__v IS NOT NULL").select("file_path", (F.col("first") + F.col("__n")).alias("__n"), "__v",
                                         _kind(F.col("__v")).alias("__kind"))
    good = docs.where(_accepted(F.col("__v"), weather, F.col("__kind")))
    line = F.shiftleft("__n", RECORD_BITS)
    if weather:
        rows = good.select("file_path", line.alias("record_pos"), F.col("__v").alias("__r"))
    else:
        rows = good.select("file_path", line.alias("__n"),
                           F.posexplode_outer(_records(F.col("__v"), F.col("__kind"))).alias("__p", "__r")) \
            .where("__r IS NOT NULL").select("file_path", (F.col("__n") + F.col("__p")).alias("record_pos"), "__r")
    schema = record_schema if record_schema is not None else _inferred(rows, "__r")
    return rows.select(*FILE_ORDER, *_fields("__r", schema, flat=weather))


# ---- Parquet snapshots (S3) --------------------------------------------

def _footer_schema(spark: SparkSession, places: str | list[str]) -> T.StructType | None:
    """The one schema that the Parquet files at ``places`` merge to: Spark reads their
    footers, and no more of them, in a job of its own.  None where they do not merge,
    or one is no Parquet file."""
    reader = spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet")
    try:
        return reader.parquet(*([places] if isinstance(places, str) else places)).schema
    except (PySparkException, Py4JJavaError):  # whatever Spark says of footers that do not fit or are none
        return None


def _kind_of(schema: T.StructType | None) -> str | None:
    """A text that names a schema: ``error`` for one with an API error column."""
    if schema is None:
        return None
    names = {f.name for f in schema} | {
        f"{f.name}.{g.name}" for f in schema if isinstance(f.dataType, T.StructType) for g in f.dataType}
    return "error" if names & set(ERROR_FIELDS) else schema.json()


def _kinds(spark: SparkSession, places: list[str], at_once: int = 8) -> list[tuple[str, str | None]]:
    """(place, kind) of folders or files, some footer jobs at a time."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(zip(places, pool.map(lambda p: _kind_of(_footer_schema(spark, p)), places)))


def parquet_kinds(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, str | None]] | None:
    """S3: the ``.parquet`` files below ``paths`` as (place, kind), from footers alone;
    kind null for a file that cannot be read.

    A place is as large as its files agree: all of ``paths``, else each folder, and
    only in a folder whose files differ, hold errors or cannot be read each file.
    None if there is no such folder.
    """
    files = _files(spark, paths, "*.parquet")
    if files is None:
        return None
    given = [paths] if isinstance(paths, str) else paths     # a file among them stands by itself
    alone = functools.reduce(Column.__or__, [F.col("path").endswith(p) for p in given])
    folder = F.when(alone, F.col("path")).otherwise(F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    files = files.where("length > 0").select("path", folder.alias("folder"))
    names = [r[0] for r in files.select("folder").distinct().orderBy("folder").collect()]
    if not names:
        return []
    whole = _kind_of(_footer_schema(spark, names))
    if whole is not None and whole != "error":
        return [(name, whole) for name in names]
    outer = {a for a, b in zip(names, names[1:]) if b.startswith(a + "/")}
    out = [(name, kind) for name, kind in _kinds(spark, [n for n in names if n not in outer])]
    mixed = outer | {name for name, kind in out if kind is None or kind == "error"}
    out = [(name, kind) for name, kind in out if name not in mixed]
    for name in sorted(mixed):
        out += _kinds(spark, [r[0] for r in files.where(F.col("folder") == name).select("path").orderBy("path").collect()])
    return out


def read_raw_parquet(spark: SparkSession, paths: str | list[str], placed: bool = True,
                     unreadable: Unreadable | None = None) -> DataFrame | None:
    """S3: snapshot files whose schemas may differ.

    Files are grouped by schema (:func:`parquet_kinds`).  Files whose schemas merge are
    one scan, a column that a file lacks is null there; else each schema is one scan,
    and the scans are unioned with the widening rules of
    :func:`contrail.operators.align.widen_type` (``mergeSchema`` cannot widen bigint to
    double).  ``placed`` adds the columns of :data:`FILE_ORDER`.
    """
    kinds = parquet_kinds(spark, paths)
    if kinds is None:
        return None
    if unreadable is not None:
        unreadable.footers = sum(kind is None for _, kind in kinds)
    groups: dict[str, list[str]] = {}
    for place, kind in kinds:
        if kind is not None and kind != "error":
            groups.setdefault(kind, []).append(place)
    frames = [spark.read.option("pathGlobFilter", "*.parquet").schema(T.StructType.fromJson(json.loads(kind)))
              .parquet(*places) for kind, places in groups.items()]
    return align_union([_placed(f) if placed else f for f in frames])


def unreadable_files(spark: SparkSession, prefix: str | list[str]) -> DataFrame:
    """Files that S4 leaves out because they cannot be read (``path``, ``reason``)."""
    none = spark.createDataFrame([], "path string, reason string")
    kinds = parquet_kinds(spark, prefix)
    if kinds is None:
        return none
    broken = json_documents(spark, prefix).where("documents IS NULL")
    lost = [(place, "no Parquet footer") for place, kind in kinds if kind is None]
    return spark.createDataFrame(lost, none.schema).unionByName(
        broken.select(F.col("file_path").alias("path"), F.lit("no JSON").alias("reason")).distinct())


def read_raw(spark: SparkSession, prefix: str | list[str], record_schema: T.StructType | None = None,
             weather: bool = False, unreadable: Unreadable | None = None) -> DataFrame | None:
    """S4 + S5: every non-empty file under ``prefix``; ``.parquet`` through S3,
    ``.json`` through S1/S2 (its schema is found where none is given), anything
    else ignored; one aligned union.  None if nothing is there.  Files that
    cannot be read are left out: :func:`unreadable_files` names them, ``unreadable``
    counts them on the way."""
    frames = [read_raw_parquet(spark, prefix, unreadable=unreadable)]
    if _files(spark, prefix) is not None and _has_documents(spark, prefix):
        frames.append(read_raw_json(spark, prefix, record_schema, weather, unreadable))
    return align_union([f for f in frames if f is not None and len(f.columns) > len(FILE_ORDER)])


# ---- dictionaries (S10, S11) --------------------------------------------

def load_dictionary(spark: SparkSession, path: str, fetch=None,
                    schema: T.StructType | None = None) -> DataFrame | None:
    """The stored dictionary; if missing or unreadable, ``fetch()``
    (a callable returning a DataFrame, e.g. a landed raw file) is stored
    and returned; nothing -> None."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return _placed(reader.parquet(path))
    except AnalysisException:  # no such folder, or no file in it that tells a schema
        if fetch is None:
            return None
    fetched = fetch()
    if fetched is None or fetched.isEmpty():
        return None
    fetched.drop(*FILE_ORDER).write.mode("overwrite").parquet(path)
    return _placed(spark.read.parquet(path))


def _placed(df: DataFrame) -> DataFrame:
    """With the place of each row, by which the last of a key is known."""
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.row_index").alias("record_pos"))


# Fixed value: carriers whose fleets are combined.
FLEET_CARRIERS = ["LO", "FR", "W6", "LH", "U2", "KL", "OS", "DY"]


def combined_fleets(spark: SparkSession, base: str, carriers=FLEET_CARRIERS) -> DataFrame | None:
    """``base/<carrier>`` fleet files of all carriers in one scan;
    a missing carrier is skipped."""
    paths = [p for p in (f"{base}/{c}" for c in carriers) if _files(spark, p) is not None]
    return read_raw_parquet(spark, paths) if paths else None
