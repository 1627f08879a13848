"""Avro files as a Spark data source, for clusters without the Avro package.

Object container files are read in ranges that start at a sync marker, so a
large file is shared by many tasks and a task holds one block at a time.
Records become Arrow batches with the columns of the requested schema; fields
nobody asked for are skipped, columns a file does not have are null or come
from folders named ``column=value``. With ``start`` and ``end``, folders of days
outside them are not listed, opened or given to tasks.
"""

from __future__ import annotations

import bz2
import io
import json
import lzma
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

NAME = "tagloom_avro"
SPLIT_BYTES = 64 << 20  # of a file that one task reads
BATCH_ROWS = 10_000
BLOCK_ROWS = 4_000  # records of a block that is written

# Fixed values of the container format.
MAGIC, SYNC_BYTES = b"Obj\x01", 16
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def register(spark: SparkSession) -> str:
    """Make the source known to a session; returns its name."""
    spark.dataSource.register(AvroSource)
    return NAME


# ---------------------------------------------------------------- decoding

Decoder = Callable[[bytes, int], tuple[object, int]]


def read_long(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at
        shift += 7


def read_bytes(data: bytes, at: int) -> tuple[bytes, int]:
    size, at = read_long(data, at)
    return data[at : at + size], at + size


def read_string(data: bytes, at: int) -> tuple[str, int]:
    size, at = read_long(data, at)
    return data[at : at + size].decode(), at + size


def fixed_width(layout: str) -> Decoder:
    shape = struct.Struct(layout)
    return lambda data, at: (shape.unpack_from(data, at)[0], at + shape.size)


PRIMITIVES: dict[str, Decoder] = {
    "null": lambda data, at: (None, at),
    "boolean": lambda data, at: (data[at] != 0, at + 1),
    "int": read_long,
    "long": read_long,
    "float": fixed_width("<f"),
    "double": fixed_width("<d"),
    "bytes": read_bytes,
    "string": read_string,
}


def items_of(item: Callable[[bytes, int], tuple[object, int]]) -> Callable[[bytes, int], tuple[list, int]]:
    """Items that come in counted blocks, as arrays and maps do."""

    def read(data: bytes, at: int) -> tuple[list, int]:
        out: list = []
        while True:
            count, at = read_long(data, at)
            if count < 0:  # followed by the size of the block in bytes
                count = -count
                _, at = read_long(data, at)
            if not count:
                return out, at
            for _ in range(count):
                value, at = item(data, at)
                out.append(value)

    return read


def decoder(schema: object, names: dict[str, object]) -> Decoder:
    """A function that reads one value of a schema; named schemas are remembered as they come."""
    if isinstance(schema, list):
        branches = [decoder(s, names) for s in schema]

        def union(data: bytes, at: int) -> tuple[object, int]:
            branch, at = read_long(data, at)
            return branches[branch](data, at)

        return union
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (dict, list)):
        return decoder(kind, names)
    if kind in PRIMITIVES:
        return PRIMITIVES[kind]
    if kind == "array":
        return items_of(decoder(schema["items"], names))
    if kind == "map":
        value = decoder(schema["values"], names)

        def pair(data: bytes, at: int) -> tuple[tuple, int]:
            key, at = read_string(data, at)
            found, at = value(data, at)
            return (key, found), at

        return items_of(pair)
    if kind in ("record", "enum", "fixed"):
        return named(schema, names)
    return lambda data, at: names[kind](data, at)  # a name, maybe of a record that is being read


def named(schema: dict, names: dict[str, object]) -> Decoder:
    kind = schema["type"]
    if kind == "record":
        fields: list[tuple[str, Decoder]] = []

        def read(data: bytes, at: int) -> tuple[object, int]:
            out = {}
            for name, field in fields:
                out[name], at = field(data, at)
            return out, at

    elif kind == "enum":
        symbols = schema["symbols"]

        def read(data: bytes, at: int) -> tuple[object, int]:
            place, at = read_long(data, at)
            return symbols[place], at

    else:
        size = schema["size"]

        def read(data: bytes, at: int) -> tuple[object, int]:
            return data[at : at + size], at + size

    names[schema["name"]] = read
    if "." not in schema["name"] and schema.get("namespace"):
        names[f"{schema['namespace']}.{schema['name']}"] = read
    if kind == "record":
        fields.extend((f["name"], decoder(f["type"], names)) for f in schema["fields"])
    return read


def snappy(data: bytes) -> bytes:
    """A snappy block: its size as a plain variable-length number, its data, a check sum."""
    size = shift = at = 0
    while True:
        size |= (data[at] & 0x7F) << shift
        if data[at] < 0x80:
            break
        at, shift = at + 1, shift + 7
    return pa.decompress(data[:-4], size, "snappy", asbytes=True)


CODECS: dict[str, Callable[[bytes], bytes]] = {
    "null": lambda data: data,
    "deflate": lambda data: zlib.decompress(data, -15),
    "snappy": snappy,
    "bzip2": bz2.decompress,
    "xz": lzma.decompress,
    "zstandard": lambda data: pa.CompressedInputStream(pa.BufferReader(data), "zstd").read(),
}


# ---------------------------------------------------------------- files


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path or address, and the path within it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path))


def stream_long(file: pa.NativeFile) -> int:
    value = shift = 0
    while True:
        byte = file.read(1)[0]
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1)
        shift += 7


@dataclass(frozen=True)
class Header:
    schema: object
    codec: str
    sync: bytes
    size: int


def read_header(file: pa.NativeFile) -> Header:
    if file.read(4) != MAGIC:
        raise ValueError("not an Avro file")
    meta = {}
    while count := stream_long(file):
        if count < 0:
            stream_long(file)
        for _ in range(abs(count)):
            key = file.read(stream_long(file)).decode()
            meta[key] = file.read(stream_long(file))
    sync = file.read(SYNC_BYTES)
    return Header(json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null").decode(), sync, file.tell())


def after_sync(file: pa.NativeFile, sync: bytes, start: int, end: int) -> int:
    """The first place behind a sync marker that starts at ``start`` or later, or ``end``."""
    at, tail = start, b""
    file.seek(start)
    while at < end + SYNC_BYTES:
        data = file.read(1 << 20)
        if not data:
            return end
        found = (tail + data).find(sync)
        if found >= 0:
            return at - len(tail) + found + SYNC_BYTES
        tail = (tail + data)[1 - SYNC_BYTES :]
        at += len(data)
    return end


def blocks(file: pa.NativeFile, start: int, end: int) -> Iterator[tuple[Header, int, bytes]]:
    """Blocks of a file that belong to a range: those whose sync marker before them starts in it."""
    head = read_header(file)
    size = file.size()
    at = head.size if start == 0 else after_sync(file, head.sync, max(start, head.size - SYNC_BYTES), end)
    while at < size and at - SYNC_BYTES < end:
        file.seek(at)
        count = stream_long(file)
        data = file.read(stream_long(file))
        if file.read(SYNC_BYTES) != head.sync:
            raise ValueError("a block of an Avro file does not end with its sync marker")
        yield head, count, CODECS[head.codec](data)
        at = file.tell()


@dataclass
class FileRange(InputPartition):
    path: str
    start: int
    end: int
    folders: dict


def folders_of(path: str, base: str) -> dict[str, str | None]:
    """Columns of the folders between a base and a file."""
    parts = (p.split("=", 1) for p in path[len(base) :].split("/")[:-1] if "=" in p)
    return {k: None if v == NO_VALUE else unquote(v) for k, v in parts}


class AvroReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options = schema, dict(options)

    def partitions(self) -> list[InputPartition]:
        store, base = store_of(self.options["path"])
        column, split = self.options.get("partition", "day"), int(self.options.get("splitBytes", SPLIT_BYTES))
        first, last = self.options.get("start"), self.options.get("end")
        out: list[InputPartition] = []
        waiting = [base]
        while waiting:
            for info in store.get_file_info(pafs.FileSelector(waiting.pop())):
                if info.base_name.startswith(("_", ".")):
                    continue
                if info.type == pafs.FileType.Directory:
                    value = folders_of(f"{info.path}/", base).get(column)
                    out_of_range = value is not None and ((first and value < first) or (last and value > last))
                    waiting += [] if out_of_range else [info.path]
                elif info.size:
                    folders = folders_of(info.path, base)
                    out += [FileRange(info.path, at, min(at + split, info.size), folders) for at in range(0, info.size, split)]
        return out

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.options["path"])
        names, target = self.schema.fieldNames(), to_arrow_schema(self.schema)
        columns: list[list] = [[] for _ in names]
        with store.open_input_file(partition.path) as file:
            read = None
            for head, count, data in blocks(file, partition.start, partition.end):
                if read is None:
                    read = record_reader(head.schema, names)
                at = 0
                for _ in range(count):
                    at = read(data, at, columns)
                if len(columns[0]) >= BATCH_ROWS:
                    yield to_batch(columns, target, partition.folders)
                    columns = [[] for _ in names]
        if columns and columns[0]:
            yield to_batch(columns, target, partition.folders)


def record_reader(schema: object, names: list[str]) -> Callable[[bytes, int, list[list]], int]:
    """A function that reads one record and appends what is asked for to the columns."""
    known: dict[str, object] = {}
    named(schema, known)  # a record may hold records of its own kind
    fields = [(f["name"], decoder(f["type"], known)) for f in schema["fields"]]
    wanted = {name: i for i, name in enumerate(names)}
    missing = [i for name, i in wanted.items() if name not in {f for f, _ in fields}]
    steps = [(wanted.get(name), field) for name, field in fields]

    def read(data: bytes, at: int, columns: list[list]) -> int:
        for place, field in steps:
            value, at = field(data, at)
            if place is not None:
                columns[place].append(value)
        for place in missing:
            columns[place].append(None)
        return at

    return read


def to_batch(columns: list[list], target: pa.Schema, folders: dict[str, str | None]) -> pa.RecordBatch:
    rows = len(columns[0])
    arrays = []
    for values, field in zip(columns, target, strict=True):
        if field.name in folders:
            arrays.append(pa.array([folders[field.name]] * rows, pa.string()).cast(field.type))
        else:
            arrays.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=target)


# ---------------------------------------------------------------- writing


def put_long(value: int) -> bytes:
    value = (value << 1) ^ (value >> 63)
    out = bytearray()
    while value > 0x7F:
        out.append((value & 0x7F) | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def put_bytes(value: bytes) -> bytes:
    return put_long(len(value)) + value


# Avro type and encoder of each simple type of Spark.
SIMPLE: dict[str, tuple[str, Callable[[object], bytes]]] = {
    "boolean": ("boolean", lambda v: b"\x01" if v else b"\x00"),
    "byte": ("int", put_long),
    "short": ("int", put_long),
    "integer": ("int", put_long),
    "long": ("long", put_long),
    "float": ("float", struct.Struct("<f").pack),
    "double": ("double", struct.Struct("<d").pack),
    "string": ("string", lambda v: put_bytes(v.encode())),
    "binary": ("bytes", put_bytes),
}


def encoder(kind: DataType, name: str) -> tuple[object, Callable[[object], bytes]]:
    """Avro schema of a type, with null, and a function that writes one value."""
    if isinstance(kind, StructType):
        parts = [(f.name, *encoder(f.dataType, f"{name}_{f.name}")) for f in kind.fields]
        schema = {"type": "record", "name": name, "fields": [{"name": n, "type": s} for n, s, _ in parts]}
        put = lambda v: b"".join(p(v[n]) for n, _, p in parts)
    elif isinstance(kind, ArrayType):
        item, one = encoder(kind.elementType, f"{name}_item")
        schema = {"type": "array", "items": item}
        put = lambda v: (put_long(len(v)) + b"".join(map(one, v)) if v else b"") + b"\x00"
    elif isinstance(kind, MapType):
        value, one = encoder(kind.valueType, f"{name}_value")
        schema = {"type": "map", "values": value}
        put = lambda v: (put_long(len(v)) + b"".join(put_bytes(k.encode()) + one(x) for k, x in v) if v else b"") + b"\x00"
    elif kind.typeName() in SIMPLE:
        schema, put = SIMPLE[kind.typeName()]
    else:
        raise TypeError(f"no Avro type for {kind.simpleString()}")
    return ["null", schema], lambda v: b"\x00" if v is None else b"\x02" + put(v)


def container(schema: StructType) -> tuple[bytes, Callable[[dict], bytes], bytes]:
    """Head of a file, encoder of its records and its sync marker."""
    (_, record), put = encoder(schema, "row")
    sync = uuid.uuid4().bytes
    meta = {b"avro.schema": json.dumps(record).encode(), b"avro.codec": b"deflate"}
    head = MAGIC + put_long(len(meta)) + b"".join(put_bytes(k) + put_bytes(v) for k, v in meta.items()) + b"\x00" + sync
    return head, lambda row: put(row)[1:], sync  # the record itself is not a union


def deflated(rows: list[bytes], sync: bytes) -> bytes:
    pack = zlib.compressobj(wbits=-15)
    data = pack.compress(b"".join(rows)) + pack.flush()
    return put_long(len(rows)) + put_bytes(data) + sync


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # staged, final


class AvroWriter(DataSourceArrowWriter):
    """Files in folders of one column, staged first and moved when all tasks are done."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.options, self.run = dict(options), uuid.uuid4().hex
        self.folder = self.options.get("partition", "day")
        self.schema = StructType([f for f in schema.fields if f.name != self.folder])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, base = store_of(self.options["path"])
        head, put, sync = container(self.schema)
        files: dict[str, tuple[io.IOBase, list[bytes], tuple[str, str]]] = {}
        for batch in iterator:
            for row in batch.to_pylist():
                value = row.get(self.folder)
                place = f"/{self.folder}={NO_VALUE if value is None else quote(str(value), safe='')}" if self.folder in row else ""
                if place not in files:
                    name = f"part-{uuid.uuid4().hex}.avro"
                    staged, final = f"{base}/_staging-{self.run}{place}/{name}", f"{base}{place}/{name}"
                    store.create_dir(os.path.dirname(staged), recursive=True)
                    files[place] = (store.open_output_stream(staged), [], (staged, final))
                    files[place][0].write(head)
                out, rows, _ = files[place]
                rows.append(put(row))
                if len(rows) >= BLOCK_ROWS:
                    out.write(deflated(rows, sync))
                    rows.clear()
        for out, rows, _ in files.values():
            if rows:
                out.write(deflated(rows, sync))
            out.close()
        return Written([names for *_, names in files.values()])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, base = store_of(self.options["path"])
        store.create_dir(base, recursive=True)
        for staged, final in (pair for m in messages if m for pair in m.files):
            store.create_dir(os.path.dirname(final), recursive=True)
            store.move(staged, final)
        self.clear(store, base)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.clear(*store_of(self.options["path"]))

    def clear(self, store: pafs.FileSystem, base: str) -> None:
        staging = f"{base}/_staging-{self.run}"
        if store.get_file_info(staging).type == pafs.FileType.Directory:
            store.delete_dir(staging)


class AvroSource(DataSource):
    """Options: ``path``; ``start`` and ``end`` of the ``partition`` column (``day``); ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        raise ValueError("name the schema to read; fields of a file that are not in it are skipped")

    def reader(self, schema: StructType) -> DataSourceReader:
        return AvroReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("this source appends; write to a new folder instead")
        return AvroWriter(schema, self.options)
