"""Records of landed JSON documents, read one by one.

A document may be far larger than a task's memory: its file is read in pieces, and the elements of
the wanted arrays leave as they are found, so a task holds one piece and one element. What is not
wanted is walked through in the same way and dropped. One file is one task; the files of a folder
spread over tasks.
"""

from __future__ import annotations

import codecs
import json
import re
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from barframe.fixed_values import SNAPSHOT_PATHS, SPLIT_DOCUMENT, SPLIT_FIELDS
from barframe.sources.files import file_system

PIECE = 1 << 20  # bytes read at a time
BATCH = 1000  # records handed on at a time, or as many as fill a piece

_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"[-+.eE0-9]*")
_DECODER = json.JSONDecoder()


class DocumentError(ValueError):
    """A document that is no JSON, or lacks a wanted array."""


class Pieces:
    """The text of a file as a buffer that is filled on demand and dropped behind the reader."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.decoder = iter(pieces), codecs.getincrementaldecoder("utf-8-sig")()
        self.text, self.at, self.ended = "", 0, False

    def more(self) -> bool:
        """Add a piece and drop what has been read; False at the end of the file."""
        if self.ended:
            return False
        piece = next(self.pieces, b"")
        self.ended = not piece
        try:
            self.text = self.text[self.at :] + self.decoder.decode(piece, final=self.ended)
        except UnicodeDecodeError as error:
            raise DocumentError(f"no UTF-8: {error.reason}") from error
        self.at = 0
        return True

    def next(self) -> str:
        """The next character that is no white space, not taken; empty at the end."""
        while True:
            self.at = _SPACE.match(self.text, self.at).end()
            if self.at < len(self.text):
                return self.text[self.at]
            if not self.more():
                return ""

    def take(self, expected: str) -> str:
        found = self.next()
        if not found or found not in expected:
            raise DocumentError(f"{expected!r} expected, {found!r} found")
        self.at += 1
        return found

    def value(self) -> str:
        """The text of the value that starts here."""
        self.next()
        while _NUMBER.match(self.text, self.at).end() == len(self.text) and self.more():  # a number may go on
            pass
        while True:
            try:
                _, end = _DECODER.raw_decode(self.text, self.at)
            except (json.JSONDecodeError, RecursionError) as error:
                # doubled, so that a long value is not parsed once per piece
                grown = [self.more() for _ in range(max(1, (len(self.text) - self.at) // PIECE))]
                if not any(grown):
                    raise DocumentError(str(error)) from error
                continue
            raw, self.at = self.text[self.at : end], end
            return raw


def _members(text: Pieces, opening: str, closing: str) -> Iterator[int]:
    """Stops at each member of an object or array; the caller takes it."""
    text.take(opening)
    if text.next() == closing:
        text.at += 1
        return
    n = 0
    while True:
        yield n
        n += 1
        if text.take("," + closing) == closing:
            return


def _skip(text: Pieces) -> None:
    """Walk through a value without keeping it."""
    first = text.next()
    if first == "[":
        for _ in _members(text, "[", "]"):
            _skip(text)
    elif first == "{":
        for _ in _members(text, "{", "}"):
            text.value()
            text.take(":")
            _skip(text)
    else:
        text.value()


def array_records(pieces: Iterable[bytes], paths: Sequence[str]) -> Iterator[tuple[str, int, str]]:
    """``(path, position, text)`` of every element of the arrays at ``paths`` (such as ``$.allSec.data``).

    A document that is no JSON, or has no array at one of the paths, raises ``DocumentError``
    where that shows. Of a key that is repeated every array counts.
    """
    text = Pieces(pieces)
    wanted = {tuple(p.removeprefix("$.").split(".")): p for p in paths}
    found: set[str] = set()

    def walk(here: tuple[str, ...]) -> Iterator[tuple[str, int, str]]:
        first = text.next()
        if here in wanted and first == "[":
            found.add(wanted[here])
            for pos in _members(text, "[", "]"):
                yield wanted[here], pos, text.value()
        elif first == "{" and any(path[: len(here)] == here and path != here for path in wanted):
            for _ in _members(text, "{", "}"):
                if text.next() != '"':
                    raise DocumentError(f"a key expected, {text.next()!r} found")
                key = json.loads(text.value())
                text.take(":")
                yield from walk((*here, key))
        else:
            _skip(text)

    yield from walk(())
    if text.next():
        raise DocumentError("text after the document")
    missing = [p for p in paths if p not in found]
    if missing:
        raise DocumentError(f"no array at {', '.join(missing)}")


class FilePartition(InputPartition):
    def __init__(self, file: str, folder: str):
        self.file, self.folder = file, folder


class RecordFileReader(DataSourceReader):
    def __init__(self, path: str, paths: list[str], strict: bool):
        self.path, self.paths, self.strict = path, paths, strict

    def partitions(self) -> list[InputPartition]:
        system, root = file_system(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        kept = [f.path for f in files if f.is_file and not any(part.startswith(("_", ".")) for part in f.path[len(root) :].split("/"))]
        return [FilePartition(f, f[len(root) :].strip("/").rpartition("/")[0]) for f in sorted(kept)]

    def _pieces(self, file: str) -> Iterator[bytes]:
        system, _ = file_system(self.path)
        with system.open_input_stream(file) as stream:
            while piece := stream.read(PIECE):
                yield piece

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        try:
            if not self.strict:  # nothing of a broken document may leave, so it is walked through first
                for _ in array_records(self._pieces(partition.file), self.paths):
                    pass
            rows, size = [], 0
            for path, pos, raw in array_records(self._pieces(partition.file), self.paths):
                rows.append((partition.folder, path, pos, raw))
                size += len(raw)
                if len(rows) == BATCH or size > PIECE:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)
        except DocumentError as error:
            if self.strict:
                raise ValueError(f"{partition.file}: {error}") from error


def _batch(rows: list[tuple[str, str, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(("folder", "path", "pos", "raw"), r, strict=True)) for r in rows], RECORDS)


RECORDS = pa.schema([("folder", pa.string()), ("path", pa.string()), ("pos", pa.int32()), ("raw", pa.string())])


class RecordFiles(DataSource):
    """``spark.read.format("record_files")`` with the options ``path``, ``arrays`` (paths joined by
    blanks) and ``strict``."""

    @classmethod
    def name(cls) -> str:
        return "record_files"

    def schema(self) -> str:
        return "folder string, path string, pos int, raw string"

    def reader(self, schema) -> RecordFileReader:
        return RecordFileReader(self.options["path"], self.options["arrays"].split(), self.options.get("strict", "true").lower() == "true")


def read_records(spark: SparkSession, path: str, arrays: Sequence[str], strict: bool = True) -> DataFrame:
    """``(folder, path, pos, raw)``: the elements of the arrays in every file under ``path``, as text.

    ``folder`` is the file's folder below ``path``. A missing file, a document that is no JSON and
    one without a wanted array are errors; without ``strict`` such a document has no records.
    """
    spark.dataSource.register(RecordFiles)
    return spark.read.format("record_files").option("arrays", " ".join(arrays)).option("strict", str(strict).lower()).load(path)


def _join_folder(parts: str, path: str, folder: str) -> None:
    (source, root), (target, top) = file_system(parts), file_system(path)
    found = [f for f in source.get_file_info(fs.FileSelector(f"{root}/{folder}")) if f.base_name.startswith("part-")]
    target.create_dir(f"{top}/{folder}")
    hidden = f"{top}/{folder}/.{uuid.uuid4().hex}"  # readers pass over it; a repeated task writes one of its own
    with target.open_output_stream(hidden, compression=None) as out:
        for part in sorted(found, key=lambda f: int(f.base_name.split("-")[1])):
            with source.open_input_stream(part.path) as stream:
                while piece := stream.read(PIECE):
                    out.write(piece)
    target.move(hidden, f"{top}/{folder}/document.json")


def join_parts(spark: SparkSession, parts: str, path: str) -> None:
    """Each folder of part files under ``parts`` as one document in a folder of that name under ``path``:
    the parts, plain or packed, in order of their numbers. One document is one task, which holds one
    piece of it. The parts are left for the owner of their folder to clear."""
    (source, root), (target, top) = file_system(parts), file_system(path)
    target.create_dir(top)
    folders = [f.base_name for f in source.get_file_info(fs.FileSelector(root)) if not f.is_file and not f.base_name.startswith(("_", "."))]
    spark.sparkContext.parallelize(sorted(folders), max(1, len(folders))).foreach(lambda folder: _join_folder(parts, path, folder))


def read_snapshot_records(
    spark: SparkSession, catalog: Mapping[str, str], paths: Mapping[str, str] = SNAPSHOT_PATHS, document: str = SPLIT_DOCUMENT,
    fields: Mapping[str, str] = SPLIT_FIELDS, strict: bool = True,
) -> DataFrame:
    """``(category, pos, raw)`` of a catalog of category -> path, documents of any size; the document
    with several fields gives a category for each. A category without a path in ``paths`` is left
    out, a missing file is an error at every setting."""
    parts = []
    for category, path in catalog.items():
        if category == document:
            names = F.create_map(*[F.lit(x) for field, name in fields.items() for x in (f"$.{field}", name)])
            parts.append(read_records(spark, path, [f"$.{field}" for field in fields], strict).select(names[F.col("path")].alias("category"), "pos", "raw"))
        elif category in paths:
            parts.append(read_records(spark, path, [paths[category]], strict).select(F.lit(category).alias("category"), "pos", "raw"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_membership_records(spark: SparkSession, path: str, indices: Sequence[str], strict: bool = True, key: str = "index_name") -> DataFrame:
    """``(index_name, pos, raw)`` of the configured indices, from folders ``index_name=...`` under ``path``."""
    escaped = F.replace(F.regexp_extract("folder", rf"(?:^|/){key}=([^/]*)", 1), F.lit("+"), F.lit("%2B"))
    return read_records(spark, path, ["$.data"], strict).select(F.url_decode(escaped).alias("index_name"), "pos", "raw").where(F.col("index_name").isin(*indices))
