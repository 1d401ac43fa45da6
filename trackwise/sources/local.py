"""Many small files in a folder that every node reaches by its path (``file:``).

Spark keeps the listing of all files it reads in the driver, and its local file system starts
a process for each file it writes. Here tasks list the folders, read the small files and write
them, so that neither the driver's memory nor a process a file bounds their number. Other
stores, large and compressed files go through Spark's own sources (``files``).
"""

from __future__ import annotations

import os
import re
import stat
import sys
import uuid
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of files, and files, of a batch of rows, at most about.
BATCH_BYTES, BATCH_FILES = 4 << 20, 2000
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz", ".lzo")


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path within the file system that every node has mounted; None in other stores."""
    m = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://[^/]*)?(/.*)$", path)
    if m:
        return m[2] if m[1].lower() == "file" else None
    if not path.startswith("/"):
        return None
    return path if (spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///").startswith("file:") else None


def tasks(spark: SparkSession) -> int:
    """A few tasks a core, each of which takes many files."""
    return 4 * spark.sparkContext.defaultParallelism


def _hidden(name: str) -> bool:
    """Names that Spark's sources pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def name_pattern(glob: str) -> re.Pattern | None:
    """Hadoop's pattern of one name; None for a plain name."""
    if not re.search(r"[*?\[{\\]", glob):
        return None
    out, i, deep = "", 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
        elif c == "[" and (end := glob.find("]", i + 2)) > 0:
            body = glob[i + 1:end]
            out += "[" + ("^" if body[0] in "^!" else "") + body[body[0] in "^!":].replace("\\", "\\\\") + "]"
            i = end
        elif c == "{" or (c == "}" and deep):
            deep += 1 if c == "{" else -1
            out += "(?:" if c == "{" else ")"
        else:
            out += {"*": ".*", "?": ".", ",": "|" if deep else ","}.get(c, re.escape(c))
        i += 1
    return re.compile(out + r"\Z", re.S)


def _below(path: str) -> Iterator[str]:
    """The files below a folder that Spark's sources see."""
    for entry in os.scandir(path):
        if not _hidden(entry.name):
            if entry.is_dir():
                yield from _below(entry.path)
            else:
                yield entry.path


def matches(path: str, names: Sequence[str]) -> Iterator[str]:
    """Paths below ``path`` that match the patterns, one of each level."""
    if not names:
        yield path
        return
    pattern = name_pattern(names[0])
    if pattern is None:
        if os.path.lexists(found := os.path.join(path, names[0])):
            yield from matches(found, names[1:])
    elif os.path.isdir(path):
        for entry in os.scandir(path):
            if pattern.match(entry.name) and not (entry.name.startswith(".") and entry.name.endswith(".crc")):
                yield from matches(entry.path, names[1:])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    path, length = zip(*rows)
    return pa.record_batch({"path": pa.array(path, pa.string()), "length": pa.array(length, pa.int64())})


def find(spark: SparkSession, path: str, folders: bool = False, name: str | None = None) -> DataFrame | None:
    """``path, length`` of the files that match a glob, listed level by level by tasks; with
    ``folders`` also those below folders that match. ``name`` is a glob that the files'
    names must match. None if that cannot be done here: another store, braces over several levels,
    or nothing there (which Spark's sources report)."""
    local = local_path(spark, path)
    if local is None or re.search(r"\{[^}]*/", local):
        return None
    names = [n for n in local.split("/") if n]
    if next(matches("/", names), None) is None:
        return None
    fixed = 0
    while fixed < len(names) and name_pattern(names[fixed]) is None:
        fixed += 1
    steps = [[n] for n in names[fixed:]]
    if not steps:
        steps = [None, []] if folders else [[]]  # None: what is in the folder
    wanted = name_pattern(name) if name else None

    def step(now: list[str] | None, last: bool):
        def found(start: str) -> Iterator[str]:
            if now is None:
                yield from (e.path for e in os.scandir(start) if not _hidden(e.name)) if os.path.isdir(start) else [start]
                return
            for p in matches(start, now):
                if last and folders and os.path.isdir(p):
                    yield from _below(p)
                else:
                    yield p

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = []
            for batch in batches:
                for start in batch.column(0).to_pylist():
                    for p in found(start):
                        if not last:
                            rows.append((p, 0))
                        elif wanted is None or wanted.match(os.path.basename(p)):
                            about = os.stat(p)
                            if stat.S_ISREG(about.st_mode):
                                rows.append((p, about.st_size))
                        if len(rows) >= 10_000:
                            yield _table(rows)
                            rows = []
            if rows:
                yield _table(rows)
        return run

    out = spark.range(0, 1, 1, 1).select(F.lit("/" + "/".join(names[:fixed])).alias("path"))
    for i, now in enumerate(steps):
        if i:
            out = out.select("path").repartition(tasks(spark))
        out = out.mapInArrow(step(now, i == len(steps) - 1), "path string, length long")
    return out


def _lines(path: str) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, lines) of the parts of a file; lines end with LF, CR LF or CR."""
    at = 0
    with open(path, encoding="latin-1", newline=None) as f:
        while text := f.read(BATCH_BYTES):
            data = (text + f.readline()).encode("latin-1")
            if not at and data.startswith(b"\xef\xbb\xbf"):
                data = data[3:]
            found = data.split(b"\n")
            if not found[-1]:
                found.pop()
            yield at, found
            at += len(found)


def _content(path: str) -> Iterator[tuple[int, list[bytes]]]:
    with open(path, "rb") as f:
        yield 0, [f.read()]


def _read(files: DataFrame, parts, path: str) -> DataFrame:
    """The columns of ``files`` with ``_at`` and ``_parts``, a row or several a file."""
    fields = [f for f in files.schema.fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["_at long", "_parts array<binary>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, found, size = [], [], [], 0

            def out() -> pa.RecordBatch:
                own = batch.take(pa.array(rows, pa.int64()))
                return pa.RecordBatch.from_arrays([*own.columns, pa.array(at, pa.int64()), pa.array(found, pa.list_(pa.binary()))],
                                                  names=[*batch.schema.names, "_at", "_parts"])

            for i, name in enumerate(batch.column(path).to_pylist()):
                for first, part in parts(name):
                    rows.append(i)
                    at.append(first)
                    found.append(part)
                    size += sum(map(len, part))
                    if size >= BATCH_BYTES or len(rows) >= BATCH_FILES:
                        yield out()
                        rows, at, found, size = [], [], [], 0
            if rows:
                yield out()

    return files.repartition(tasks(files.sparkSession)).mapInArrow(run, schema)


def read_lines(files: DataFrame, path: str = "npath") -> DataFrame:
    """Every line of the files, numbered from 0 in each: the columns of ``files``, ``line_no``, ``line``."""
    return _read(files, _lines, path).select(*files.columns, "_at", F.posexplode("_parts").alias("_i", "line")).select(
        *files.columns, (F.col("_at") + F.col("_i")).alias("line_no"), F.col("line").cast("string").alias("line"))


def read_whole(files: DataFrame, path: str = "path") -> DataFrame:
    """The columns of ``files`` and ``content``."""
    return _read(files, _content, path).select(*files.columns, F.get("_parts", F.lit(0)).alias("content"))


#: Spark's name of the folder of null, and the characters that it writes as %XX in folder names.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def write_lines(rows: DataFrame, keys: Sequence[str], order: Sequence[str], header: Sequence[str], root: str) -> None:
    """A file ``root/key=value/.../part-00000.txt`` for each value of the keys (text): the header, then
    ``value`` of its rows in order. A file appears under its name when it is whole, so
    a task may run again."""
    if os.path.exists(root):
        raise FileExistsError(root)
    n = len(keys)
    head = "".join(h + "\n" for h in header)

    def folder(values: tuple) -> str:
        return os.path.join(root, *[f"{k}=" + ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", v) for k, v in zip(keys, values)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, file, temp, files = None, None, "", 0

        def close() -> None:
            file.close()
            os.replace(temp, os.path.join(folder(now), "part-00000.txt"))

        try:
            for batch in batches:
                cols = [c.to_pylist() for c in batch.columns]
                at = 0
                for values, group in groupby(zip(*cols[:n])):
                    end = at + sum(1 for _ in group)
                    if values != now:
                        if file:
                            close()
                        now = values
                        os.makedirs(folder(now), exist_ok=True)
                        temp = os.path.join(folder(now), f".{uuid.uuid4().hex}.tmp")
                        file = open(temp, "w", encoding="utf-8", newline="")
                        file.write(head)
                        files += 1
                    file.write("".join([(v or "") + "\n" for v in cols[n][at:end]]))
                    at = end
            if file:
                close()
        except BaseException:
            if file and not file.closed:
                file.close()
                os.unlink(temp)
            raise
        yield pa.record_batch({"files": pa.array([files], pa.int64())})

    named = rows.withColumns({k: F.coalesce(k, F.lit(NULL_FOLDER)) for k in keys})
    dealt = named.repartition(tasks(rows.sparkSession), *keys).sortWithinPartitions(*keys, *order)
    dealt.select(*keys, "value").mapInArrow(run, "files long").write.format(
        "noop").mode("overwrite").save()
