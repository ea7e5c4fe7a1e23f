"""Landing -> bronze: incremental file ingestion with schema evolution,
rescued data and row lineage, on the open-source file stream source.

One :class:`Feed` describes a feed.  :func:`run_bronze` does, per run:

1. **Schema registry** (``<checkpoint>/_schema/registry/<n>.json``, append-only): before the
   stream starts, the names of *new* files are learnt — CSV: the header line
   after ``skip_rows`` preamble lines, read from the first lines of each new
   file only; JSON Lines: keys, by Spark's distributed inference over the new
   files.  Names are sanitised; with ``addNewColumns`` the registry grows
   (old rows read as NULL), with ``rescue`` it stays fixed.
2. **Scan** as a text stream (exactly-once through the stream checkpoint;
   files are keyed by path).  CSV lines are split with ``from_csv`` and mapped
   to registry names *by the header of their own file* (a stream-static join
   with the per-file header table), so files with reordered or extra columns
   land correctly; preamble and header lines are dropped by their place in the
   file; surplus fields and unknown JSON keys go to ``_rescued_data`` (JSON
   text), and so does the raw text of a line that does not parse.
3. **Lineage**: ``_metadata`` (file struct), ``_source_file``, ``_ingested_at``
   and ``_row_hash`` = SHA-256 over all data columns (after renaming,
   including partition and rescued columns).
4. **Sink**: parquet files + checkpoint, ``availableNow`` trigger (process what
   is there, then stop).  Read the bronze table with ``mergeSchema``.

All data columns stay strings in bronze; typing happens in silver.
Limitation: values spanning several lines (``multiLine``) are not supported by
the line-based scan; the option is refused.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from punctua.functions.columns import row_hash
from punctua.sources import hadoopfs as hfs
from punctua.sources.naming import sanitize_expr, sanitize_name

RESCUED = "_rescued_data"
HEADER_READERS = 16
BOM = "\ufeff"
#: Fields beyond the widest header that are kept one by one; a line with more keeps its raw text.
SURPLUS = 64
END = "\u0003end"
PARTITION_SEGMENT = re.compile(r"/([^/=]+)=([^/]*)/")


@dataclass(frozen=True)
class Places:
    """Where a feed's files land (and which count, by name), where its state is kept, and its bronze table."""
    landing: str
    system: str
    bronze: str
    files: str = "*"


@dataclass(frozen=True)
class Parser:
    """How a file's lines become fields: ``csv`` (with ``preamble`` lines before the header) or ``json``, one record a line."""
    kind: str = "csv"
    options: Mapping[str, str] = field(default_factory=dict)
    preamble: int = 0

    def __post_init__(self) -> None:
        if self.kind not in ("csv", "json"):
            raise ValueError(f"unknown kind of file {self.kind!r}")
        if self.opt("multiLine", "false").lower() == "true":
            raise ValueError("multiLine is not supported: the scan reads lines")
        try:
            line_end = "\n".encode(self.charset)
        except LookupError:
            raise ValueError(f"unknown charset {self.charset!r}") from None
        if line_end != b"\n":
            raise ValueError(f"charset {self.charset!r} is not supported: the scan splits lines at single bytes")

    def opt(self, key: str, default: str) -> str:
        for k, v in self.options.items():
            if k.lower() == key.lower():
                return str(v)
        return default

    @property
    def charset(self) -> str:
        """Of headers and rows alike."""
        return self.opt("encoding", self.opt("charset", "UTF-8"))

    @property
    def skipped(self) -> int:
        """Lines before the header."""
        return self.preamble or int(self.opt("skipRows", "0"))

    @property
    def has_header(self) -> bool:
        """CSV files name their columns unless the option ``header`` says otherwise."""
        return self.opt("header", "true").lower() == "true"

    @property
    def first_row(self) -> int:
        """Lines before a file's first data row."""
        return self.skipped + self.has_header if self.kind == "csv" else 0


@dataclass(frozen=True)
class Feed:
    """A source to ingest. Columns that later files bring are added to the table, or, without ``new_columns``, rescued."""
    places: Places
    parser: Parser = field(default_factory=Parser)
    new_columns: bool = True

    @property
    def schema_dir(self) -> str:
        return self.places.system.rstrip("/") + "/_schema"

    @property
    def stream_checkpoint(self) -> str:
        return self.places.system.rstrip("/") + "/_checkpoint"


def feed(landing: str, system: str, bronze: str, kind: str = "csv", files: str = "*", preamble: int = 0,
         options: Mapping[str, str] | None = None, new_columns: bool = True) -> Feed:
    """A :class:`Feed` from its parts."""
    return Feed(Places(landing, system, bronze, files), Parser(kind, options or {}, preamble), new_columns)


# --------------------------------------------------------------------------- registry
MANIFEST_SCHEMA = "hf string, header array<string>"
MANIFEST_MAX_FILES = 64


@dataclass
class Registry:
    """Column names (registry JSON, small) plus the per-file manifest (parquet).

    The manifest holds one row per file ever discovered — path and its
    sanitised header — and is appended
    once per run, so it grows by files, never by rows, and is read by Spark.
    """
    columns: list[str]
    partitions: list[str]
    manifest_path: str

    def to_json(self) -> str:
        return json.dumps({"columns": self.columns, "partitions": self.partitions})

    @classmethod
    def load(cls, spark: SparkSession, cfg: Feed) -> Registry:
        versions = [n for n in hfs.list_names(spark, cfg.schema_dir + "/registry") if n.endswith(".json")]
        text = hfs.read_text(spark, f"{cfg.schema_dir}/registry/{versions[-1]}") if versions else None
        manifest = cfg.schema_dir + "/files"
        if not text:
            return cls([], [], manifest)
        d = json.loads(text)
        return cls(d["columns"], d["partitions"], manifest)

    def save(self, spark: SparkSession, cfg: Feed) -> None:
        # append-only: a new numbered file per change, readers take the highest;
        # a crash never leaves the registry missing or half written
        versions = [n for n in hfs.list_names(spark, cfg.schema_dir + "/registry") if n.endswith(".json")]
        if versions and hfs.read_text(spark, f"{cfg.schema_dir}/registry/{versions[-1]}") == self.to_json():
            return
        nxt = int(versions[-1].split(".")[0]) + 1 if versions else 0
        hfs.write_text(spark, f"{cfg.schema_dir}/registry/{nxt:010d}.json", self.to_json())

    def manifest(self, spark: SparkSession) -> DataFrame:
        # one row per file; duplicates (left by an interrupted compaction) are dropped on read
        if hfs.exists(spark, self.manifest_path):
            return spark.read.schema(MANIFEST_SCHEMA).parquet(self.manifest_path).dropDuplicates(["hf"])
        return spark.createDataFrame([], MANIFEST_SCHEMA)

    def compact(self, spark: SparkSession, max_files: int = MANIFEST_MAX_FILES) -> bool:
        """Rewrite the manifest into one file once it holds more than ``max_files`` files.

        The merged file is appended first and the old files are deleted after, so
        an interruption only leaves duplicate rows, which readers drop."""
        parts = [n for n in hfs.list_names(spark, self.manifest_path) if n.endswith(".parquet")]
        if len(parts) <= max_files:
            return False
        old = [f"{self.manifest_path}/{n}" for n in parts]
        merged = spark.read.schema(MANIFEST_SCHEMA).parquet(*old).dropDuplicates(["hf"])
        merged.coalesce(1).write.mode("append").parquet(self.manifest_path)
        for n in parts:
            hfs.delete(spark, f"{self.manifest_path}/{n}")
        return True


def _split_csv_line(line: str, sep: str, quote: str) -> list[str]:
    import csv
    return next(csv.reader([line], delimiter=sep, quotechar=quote))


def _add(names: list[str], new: list[str]) -> None:
    for n in new:
        if n not in names:
            names.append(n)


def new_files(spark: SparkSession, cfg: Feed, reg: Registry) -> list[str]:
    """Listed files not yet in the manifest (``left_anti`` in Spark; only the new paths come back)."""
    listing = hfs.list_files(spark, cfg.places.landing, cfg.places.files)
    if not listing:
        return []
    lf = spark.createDataFrame([(f.path,) for f in listing], "hf string")
    return sorted(r["hf"] for r in lf.join(reg.manifest(spark).select("hf"), "hf", "left_anti").collect())


def discover(spark: SparkSession, cfg: Feed) -> Registry:
    """Update the registry with the files that are new since the last run."""
    reg = Registry.load(spark, cfg)
    new = new_files(spark, cfg, reg)
    base = hfs.qualify(spark, cfg.places.landing).rstrip("/")
    for path in new:
        for k, _ in PARTITION_SEGMENT.findall(path[len(base):].rsplit("/", 1)[0] + "/"):
            if k not in reg.partitions:
                reg.partitions.append(k)
    evolve = cfg.new_columns or not reg.columns
    entries = []
    if cfg.parser.kind == "csv":
        sep, quote = cfg.parser.opt("sep", ","), cfg.parser.opt("quote", '"')
        enc = cfg.parser.charset
        # only the preamble and one more line of each *new* file are read, several files at a time
        with ThreadPoolExecutor(max_workers=HEADER_READERS) as pool:
            heads = list(pool.map(lambda p: hfs.head_lines(spark, p, cfg.parser.skipped + 1, enc), new))
        for path, lines in zip(new, heads):
            if len(lines) <= cfg.parser.skipped:
                entries.append((path, []))
                continue
            raw = _split_csv_line(lines[cfg.parser.skipped].lstrip(BOM), sep, quote)
            names = [sanitize_name(n) for n in raw] if cfg.parser.has_header else [f"_c{i}" for i in range(len(raw))]
            if len(set(names)) != len(names):
                raise ValueError(f"column names collide after sanitising in {path}: {raw}")
            entries.append((path, names))
            if evolve:
                _add(reg.columns, names)
    elif cfg.parser.kind == "json":
        if new:
            inferred = (spark.read.options(**{k: v for k, v in cfg.parser.options.items()})
                        .option("primitivesAsString", "true").json(new))
            names = [sanitize_name(n) for n in inferred.columns if n != "_corrupt_record"]
            if evolve:
                _add(reg.columns, names)
            entries = [(path, []) for path in new]
    for p in reg.partitions:
        if p in reg.columns:
            reg.columns.remove(p)
    if entries:
        spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(reg.manifest_path)
        reg.compact(spark)
    reg.save(spark, cfg)
    return reg


# --------------------------------------------------------------------------- scan
# Options consumed by the scan itself rather than by the record parser.
SCAN_OPTIONS = {"header", "skiprows", "encoding", "charset", "pathglobfilter", "recursivefilelookup",
                "multiline", "inferschema", "primitivesasstring"}
# Rate control and file selection, passed to the stream.
STREAM_OPTIONS = {"maxfilespertrigger", "maxbytespertrigger", "latestfirst", "maxfileage", "modifiedbefore",
                  "modifiedafter"}


def parser_options(cfg: Feed) -> dict[str, str]:
    """Free-form reader options passed through to ``from_csv``/``from_json``."""
    opts = {k: str(v) for k, v in cfg.parser.options.items() if k.lower() not in SCAN_OPTIONS | STREAM_OPTIONS}
    if cfg.parser.kind == "csv":
        opts.setdefault("sep", ",")
        opts.setdefault("quote", '"')
    return opts


def drop_first(lines: DataFrame, n: int, encoding: str = "UTF-8") -> DataFrame:
    """``lines`` (value, _metadata) of a text scan without the first ``n`` lines of each file, decoded.

    Spark has no line number for text, but a task reads a split in file order: lines of a file's first block are
    counted as they pass. Only these counters are kept."""
    utf8 = encoding.replace("-", "").lower() == "utf8"
    if not n and utf8:
        return lines
    schema = lines.schema

    def passed(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        seen: dict[str, int] = {}
        for batch in batches:
            meta = batch.column(1)
            head = pc.equal(pc.struct_field(meta, "file_block_start"), 0)
            keep = [True] * batch.num_rows
            if n and pc.any(head).as_py():
                paths = pc.struct_field(meta, "file_path").dictionary_encode()
                for k, path in enumerate(paths.dictionary.to_pylist()):
                    if seen.get(path, 0) < n:
                        here = pc.indices_nonzero(pc.and_(head, pc.equal(paths.indices, k)))[:n - seen.get(path, 0)]
                        seen[path] = seen.get(path, 0) + len(here)
                        for i in here.to_pylist():
                            keep[i] = False
            text = batch.column(0)
            if not utf8:
                text = pa.array([x.decode(encoding) for x in text.cast(pa.binary()).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([text, meta], names=["value", "_metadata"]).filter(pa.array(keep))

    raw = lines if utf8 else lines.withColumn("value", F.col("value").cast("binary"))
    return raw.mapInArrow(passed, schema)


def file_path() -> Column:
    """Path of a line's file as a listing names it; ``_metadata`` holds it URL-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _lines(spark: SparkSession, cfg: Feed) -> DataFrame:
    r = spark.readStream.format("text").options(
        **{k: str(v) for k, v in cfg.parser.options.items() if k.lower() in STREAM_OPTIONS})
    lines = (r.option("pathGlobFilter", cfg.places.files).option("recursiveFileLookup", "true")
             .load(cfg.places.landing)
             .select("value", "_metadata"))
    return drop_first(lines, cfg.parser.first_row, cfg.parser.charset)


def _partition_cols(reg: Registry) -> dict[str, Column]:
    """Values of ``name=value`` folders, unescaped; the default partition is NULL."""
    def value(p: str) -> Column:
        stored = F.regexp_extract(file_path(), f"/{re.escape(p)}=([^/]*)/", 1)
        plain = F.coalesce(F.try_url_decode(F.replace(stored, F.lit("+"), F.lit("%2B"))), stored)
        return F.when(~plain.isin("", "__HIVE_DEFAULT_PARTITION__"), plain)

    return {p: value(p) for p in reg.partitions}


def _csv_frame(spark: SparkSession, cfg: Feed, reg: Registry) -> DataFrame:
    """Lines -> registry columns by each file's own header; surplus fields are kept in
    ``_rescued_data``, and of a line with more than SURPLUS of them, or with an open quote, the raw text."""
    headers = reg.manifest(spark)
    width = (headers.agg(F.max(F.size("header"))).first()[0] or 1) + SURPLUS + 1
    pos_schema = ", ".join(f"c{i} string" for i in range(width))
    lines = _lines(spark, cfg)
    j = lines.join(headers, file_path() == F.col("hf"), "left")
    # a file that landed after discovery has no header yet: fail the micro-batch (nothing is
    # committed, the next run discovers the file) instead of dropping its rows silently
    unknown_file = F.raise_error(F.concat(F.lit("file landed during the run, re-run to ingest it: "),
                                          F.col("_metadata.file_path")))
    j = j.filter(F.when(F.col("hf").isNull(), unknown_file.cast("boolean")).otherwise(F.lit(True)))
    j = j.filter(F.length("value") > 0)
    # an end mark as a last field tells how many fields a line has
    marked = F.concat(F.col("value"), F.lit(cfg.parser.opt("sep", ",") + END))
    parsed = j.withColumn("_v", F.from_csv(marked, pos_schema, parser_options(cfg)))
    vals = F.array(*[F.col("_v")[f"c{i}"] for i in range(width)])
    parsed = parsed.withColumn("_all", vals).withColumn("_n", F.coalesce(
        F.array_position("_all", END), F.lit(0)).cast("int") - 1)
    parsed = parsed.withColumn("_vals", F.when(F.col("_n") >= 0, F.slice(F.col("_all"), F.lit(1), F.greatest("_n", F.lit(0))))
                               .otherwise(F.transform("_all", lambda x: F.replace(
                                   x, F.lit(cfg.parser.opt("sep", ",") + END), F.lit("")))))
    cols = {}
    for name in reg.columns:
        pos = F.array_position(F.col("header"), F.lit(name)).cast("int")
        cols[name] = F.when(pos > 0, F.get(F.col("_vals"), pos - 1))
    surplus = F.slice(F.col("_vals"), F.size("header") + 1, width)  # empty fields keep their places
    rescued_values = surplus
    if not cfg.new_columns:
        unknown = F.filter(F.col("header"), lambda h: ~h.isin(*reg.columns)) if reg.columns else F.col("header")
        rescued_values = F.concat(
            F.transform(unknown, lambda h: F.get(F.col("_vals"), F.array_position(F.col("header"), h).cast("int") - 1)),
            surplus)
    rescued = (F.when(F.col("_n") < 0, F.to_json(F.array("value")))
               .when(F.exists(rescued_values, lambda x: x.isNotNull()), F.to_json(rescued_values)))
    return parsed.select(*[e.alias(n) for n, e in cols.items()], rescued.alias(RESCUED), "_metadata")


def _json_frame(spark: SparkSession, cfg: Feed, reg: Registry) -> DataFrame:
    lines = _lines(spark, cfg).filter(F.length(F.trim("value")) > 0)
    as_map = F.transform_keys(F.from_json(F.col("value"), "map<string,string>", parser_options(cfg)),
                              lambda k, v: sanitize_expr(k))
    m = lines.withColumn("_m", as_map)
    known = set(reg.columns) | set(reg.partitions)
    cols = {name: F.col("_m")[name] for name in reg.columns}
    rest = F.map_filter(F.col("_m"), lambda k, v: ~k.isin(*known) if known else F.lit(True))
    rescued = F.when(F.col("_m").isNull(), F.col("value")).when(F.size(rest) > 0, F.to_json(rest))
    return m.select(*[e.alias(n) for n, e in cols.items()], rescued.alias(RESCUED), "_metadata")


def bronze_frame(spark: SparkSession, cfg: Feed, reg: Registry | None = None) -> DataFrame:
    reg = reg or discover(spark, cfg)
    df = _csv_frame(spark, cfg, reg) if cfg.parser.kind == "csv" else _json_frame(spark, cfg, reg)
    df = df.withColumns(_partition_cols(reg))
    data_cols = [c for c in df.columns if c != "_metadata"]
    return with_lineage(df, data_cols)


def with_lineage(df: DataFrame, data_cols: list[str]) -> DataFrame:
    return df.withColumns({
        "_source_file": F.col("_metadata.file_path"),
        "_ingested_at": F.current_timestamp(),
        "_row_hash": row_hash(data_cols),
    })


def run_bronze(spark: SparkSession, cfg: Feed, wait: bool = True) -> StreamingQuery | None:
    """Ingest every file not yet ingested, then stop (``availableNow``).

    Returns None when nothing has landed yet (no file ever seen)."""
    reg = discover(spark, cfg)
    if not reg.columns and not hfs.exists(spark, reg.manifest_path):
        return None
    df = bronze_frame(spark, cfg, reg)
    q = (df.writeStream.format("parquet")
         .option("checkpointLocation", cfg.stream_checkpoint)
         .option("path", cfg.places.bronze)
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
    return q


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def bronze_schema(spark: SparkSession, path: str) -> T.StructType:
    return read_bronze(spark, path).schema
