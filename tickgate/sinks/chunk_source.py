"""The per-chunk layout as a Spark data source (K1, S6): ``format("tickgate_chunks")``.

Writing follows Spark's two-step commit. A task writes its chunks and their outcomes into a folder of its own attempt
below ``{path}/_staging-{run}``, which no reader lists. Spark lets one attempt of a task commit; when all tasks have, the
chunks of just these attempts are moved into place and the staging folder goes, with all that lost or speculative
attempts left there. A job that fails is aborted: the folder goes and no chunk has changed. Commit messages name an
attempt each, whatever the number of its chunks; the outcomes of one attempt at a time are read while moving.
A driver that dies while moving leaves whole chunks, old or new, and the staging folder; a rerun writes them again.

Reading lists and probes chunk files: the driver lists the symbol folders only and deals them to partitions; tasks list
the files below and read their footers.

Options: ``path`` (qualified); to write ``run``, ``ledger`` (folder for the outcomes) and ``row_group``; to read
``schema_name``, ``symbol`` (optional) and ``tasks``.
"""
from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tickgate.config import PARQUET_COMPRESSION, PARQUET_ROW_GROUP
from tickgate.functions import keys as K
from tickgate.session import arrow_uri

NAME = "tickgate_chunks"
KEY = ["schema", "symbol", "venue", "year_month"]
LEDGER_SCHEMA = ("schema string, symbol string, venue string, year_month string, path string, rows bigint, size_bytes bigint, "
                 "success boolean, message string, elapsed double")
PROBE_SCHEMA = "path string, size_bytes bigint, state string, rows bigint, columns array<string>"
MESSAGE_CHARS = 200
MOVES = 16      # files that the driver moves at a time


def _filesystem(path: str):
    import pyarrow.fs as pafs
    return pafs.FileSystem.from_uri(arrow_uri(path))


def _ledger_table(rows: list[tuple]):
    import pyarrow as pa
    types = [pa.string()] * 5 + [pa.int64()] * 2 + [pa.bool_(), pa.string(), pa.float64()]
    cols = list(zip(*rows)) if rows else [[]] * len(types)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                names=[c.split()[0] for c in LEDGER_SCHEMA.split(", ")])


class ChunkFile:
    """One chunk's file below ``base``; its outcome is a row of LEDGER_SCHEMA."""

    def __init__(self, fs, base: str, key: tuple, schema, row_group: int):
        import pyarrow.parquet as pq
        self.fs, self.key, self.row_group = fs, key, row_group
        self.started = time.monotonic()
        self.held, self.n, self.error, self.out = [], 0, None, None
        part = [K.NO_KEY if x is None else x for x in key]
        self.folder = "/".join([base.rstrip("/"), part[0], part[1], part[2].replace(".", "_")])
        self.final = f"{self.folder}/{part[3]}.parquet"

        def open_():
            fs.create_dir(self.folder, recursive=True)
            # the frame's own types, so that all chunks of a run agree whatever their values
            self.out = pq.ParquetWriter(self.final, schema, filesystem=fs, compression=PARQUET_COMPRESSION)
        self._try(open_)

    def _try(self, step) -> None:
        """A step that fails ends this chunk, not the task: its message is the chunk's outcome."""
        if self.error is None:
            try:
                step()
            except Exception as e:  # noqa: BLE001 - any failure of one chunk is a result
                self.error = (str(e) or type(e).__name__)[:MESSAGE_CHARS]
                self._discard()

    def _discard(self) -> None:
        self.held = []
        for step in ((lambda: self.out.close()), (lambda: self.fs.delete_file(self.final))):
            try:
                step()
            except Exception:  # noqa: BLE001, S110 - nothing was written
                pass

    def add(self, rows) -> None:
        def put():
            self.held.append(rows)
            self.n += len(rows)
            if sum(map(len, self.held)) >= self.row_group:
                self._flush(False)
        self._try(put)

    def _flush(self, all_rows: bool) -> None:
        import pyarrow as pa
        table = pa.Table.from_batches(self.held)
        cut = len(table) if all_rows else len(table) - len(table) % self.row_group
        if cut:
            self.out.write_table(table.slice(0, cut), row_group_size=self.row_group)
        self.held = table.slice(cut).to_batches()

    def outcome(self) -> tuple:
        """Ends the file and tells what became of the chunk."""
        import pyarrow.parquet as pq
        size = None

        def finish():
            nonlocal size
            if self.held:
                self._flush(True)
            self.out.close()
            with self.fs.open_input_file(self.final) as fh:
                there = pq.ParquetFile(fh).metadata.num_rows
            if there != self.n:
                raise OSError(f"corrupt: {there} rows of {self.n} in the file")
            size = self.fs.get_file_info(self.final).size
        self._try(finish)
        took = time.monotonic() - self.started
        if self.error is not None:
            return (*self.key, None, 0, None, False, self.error, took)
        return (*self.key, self.final, self.n, size, True, f"{self.n:,} rows", took)


@dataclass
class Attempt(WriterCommitMessage):
    """The folder of one attempt's files; no name if it got no rows."""

    name: str


class ChunkWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.ledger = options["path"].rstrip("/"), options["ledger"].rstrip("/")
        self.staging = f"_staging-{options['run']}"
        self.row_group = int(options.get("row_group", PARQUET_ROW_GROUP))

    def write(self, iterator: Iterator) -> Attempt:
        """Rows come sorted by chunk; one file is open at a time."""
        import pyarrow.parquet as pq
        fs, base = _filesystem(self.path)
        attempt = uuid.uuid4().hex
        folder = f"{base}/{self.staging}/{attempt}"
        cur, done = None, []
        for batch in iterator:
            keys = list(zip(*(batch.column(k).to_pylist() for k in KEY)))
            body = batch.drop_columns(["schema", "year_month"])
            cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if cur is None or keys[lo] != cur.key:
                    if cur is not None:
                        done.append(cur.outcome())
                    cur = ChunkFile(fs, folder, keys[lo], body.schema, self.row_group)
                cur.add(body.slice(lo, hi - lo))
        if cur is not None:
            done.append(cur.outcome())
        if not done:
            return Attempt("")
        fs.create_dir(folder, recursive=True)
        pq.write_table(_ledger_table(done), f"{folder}/ledger.parquet", filesystem=fs)
        return Attempt(attempt)

    def commit(self, messages: list) -> None:
        from concurrent.futures import ThreadPoolExecutor

        import pyarrow.parquet as pq
        fs, base = _filesystem(self.path)
        ledger_fs, ledger = _filesystem(self.ledger)
        ledger_fs.create_dir(ledger, recursive=True)
        with ThreadPoolExecutor(MOVES) as pool:
            for m in messages:
                if m is None or not m.name:
                    continue
                folder = f"{base}/{self.staging}/{m.name}"
                rows = pq.read_table(f"{folder}/ledger.parquet", filesystem=fs).to_pylist()
                placed = list(pool.map(lambda r: _place(fs, folder, base, tuple(r.values())), rows))  # noqa: B023
                pq.write_table(_ledger_table(placed), f"{ledger}/{m.name}.parquet", filesystem=ledger_fs)
        self._clear(fs, base)

    def abort(self, messages: list) -> None:
        self._clear(*_filesystem(self.path))

    def _clear(self, fs, base: str) -> None:
        """Removes this run's staging folder, which holds nothing but what its own tasks wrote."""
        from pyarrow.fs import FileType
        if fs.get_file_info(f"{base}/{self.staging}").type == FileType.Directory:
            fs.delete_dir(f"{base}/{self.staging}")


def _place(fs, folder: str, base: str, row: tuple) -> tuple:
    """Moves a staged chunk into place, over an older one; the outcome with its final path, or why that failed."""
    from pyarrow.fs import FileType
    key, staged = row[:4], row[4]
    if staged is None:
        return row
    final = base + staged[len(folder):]
    try:
        fs.create_dir(final.rsplit("/", 1)[0], recursive=True)
        try:
            fs.move(staged, final)
        except OSError:      # some file systems do not rename over a file
            if fs.get_file_info(final).type != FileType.File:
                raise
            fs.delete_file(final)
            fs.move(staged, final)
    except Exception as e:  # noqa: BLE001 - any failure of one chunk is a result
        return (*key, None, 0, None, False, (str(e) or type(e).__name__)[:MESSAGE_CHARS], row[9])
    return (*key, final, *row[5:])


@dataclass
class Folders(InputPartition):
    names: list


class ChunkReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.schema_name = options["path"].rstrip("/"), options["schema_name"]
        self.symbol, self.tasks = options.get("symbol"), int(options.get("tasks", 32))

    def partitions(self) -> list:
        from pyarrow.fs import FileSelector
        fs, base = _filesystem(f"{self.path}/{self.schema_name}")
        names = [i.base_name for i in fs.get_file_info(FileSelector(base)) if not _hidden(i.base_name)]
        names = sorted(n for n in names if self.symbol in (None, n))
        n = max(1, min(self.tasks, len(names)))
        return [Folders(names[i::n]) for i in range(n)]

    def read(self, partition: Folders) -> Iterator:
        from pyarrow.fs import FileSelector, FileType
        fs, base = _filesystem(f"{self.path}/{self.schema_name}")
        for name in partition.names:
            top = fs.get_file_info(f"{base}/{name}")
            infos = [top] if top.type == FileType.File else fs.get_file_info(FileSelector(top.path, recursive=True))
            for info in infos:
                rel = info.path[len(base):]
                if info.type == FileType.File and rel.endswith(".parquet") and not any(map(_hidden, rel.split("/")[1:])):
                    yield (f"{self.path}/{self.schema_name}{rel}", info.size, *_footer(fs, info.path))


def _hidden(name: str) -> bool:
    """Names that Spark's own listings skip."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _footer(fs, path: str) -> tuple:
    import pyarrow.parquet as pq
    try:
        with fs.open_input_file(path) as fh:
            md = pq.ParquetFile(fh).metadata
            names = [md.schema.column(i).path.split(".")[0] for i in range(md.num_columns)]
    except Exception:  # noqa: BLE001 - an unreadable file is a result, not an error
        return ("corrupt", None, None)
    return ("ok" if md.num_rows else "empty", md.num_rows, list(dict.fromkeys(names)))


class ChunkSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return PROBE_SCHEMA

    def reader(self, schema) -> ChunkReader:
        return ChunkReader(self.options)

    def writer(self, schema, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options)
