"""Settings: rule thresholds, object store, JDBC targets, layer paths."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class RuleSettings:
    # The default thresholds of the two rules.
    amount_limit: float = 5000
    velocity_limit: int = 3
    velocity_seconds: int = 60


@dataclass(frozen=True)
class StoreSettings:
    """An S3-compatible object store.  Secrets have no default."""

    endpoint: str
    access_key: str = field(repr=False)
    secret_key: str = field(repr=False)
    path_style: bool = True


@dataclass(frozen=True)
class JdbcTarget:
    """One serving table.

    ``mode``: "append", "skip_existing", "staged" or "upsert" (see ``sources.jdbc``).
    ``num_partitions`` is the number of parallel connections of a write or key read.
    ``key_predicates`` are WHERE clauses that together cover the table: reads
    use one task per clause.  Without them "skip_existing" makes its own, with
    the database's hash of the key if ``key_hash`` gives one (``{key}`` stands
    for the column), else from ranges of the batch's keys.  ``fetch_size``: rows
    that a read holds at a time; some drivers hold the whole result without.
    ``batch_id`` names what is written, so that "staged" and "upsert" move it over once.
    """

    url: str
    table: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    mode: str = "append"
    key: str = "event_id"
    batch_size: int = 10_000
    num_partitions: int | None = 32
    column_types: str | None = None
    key_predicates: tuple[str, ...] = ()
    key_hash: str = ""
    index_key: bool = False
    fetch_size: int = 10_000
    batch_id: str = ""

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.table, "driver": self.driver}
        if self.user:
            opts["user"] = self.user
        if self.password:
            opts["password"] = self.password
        return opts

    def read_options(self) -> dict[str, str]:
        return {**self.options(), "fetchsize": str(self.fetch_size)}

    def write_options(self) -> dict[str, str]:
        opts = {**self.options(), "batchsize": str(self.batch_size)}
        if self.num_partitions:
            opts["numPartitions"] = str(self.num_partitions)
        if self.column_types:
            opts["createTableColumnTypes"] = self.column_types
        return opts


def mariadb_target(host: str, database: str, table: str, user: str, password: str, **extra) -> JdbcTarget:
    # Address format, port and driver class for MariaDB.  The
    # mysql prefix makes Spark use its MySQL dialect with the MariaDB driver.
    extra = {"key_hash": "CRC32({key})", **extra}
    return JdbcTarget(
        url=f"jdbc:mysql://{host}:3306/{database}?permitMysqlScheme=true",
        driver="org.mariadb.jdbc.Driver",
        table=table,
        user=user,
        password=password,
        **extra,
    )


@dataclass(frozen=True)
class PipelineConfig:
    """Where the layers live and how the four jobs behave.

    ``bad_records``: "keep" lets malformed lines through as all-NULL rows;
    "quarantine" moves them, with the raw line, to ``quarantine``.
    ``dedup``: "latest" (reproducible) or "any" (an arbitrary survivor).
    ``features``, if given, is where training stores the rows it learns from,
    ``quality`` where ingestion stores its counts on silver, and ``blacklist``
    a layer of listed users that gold rows are marked by.
    ``atomic``: layers are replaced by publishing a snapshot (see ``sources.layers``);
    without it they are plain folders, as tools that know nothing of snapshots need them.
    ``serve_probability`` adds ``fraud_probability`` to the predictions' serving table.
    """

    landing: str = ""
    bronze: str = ""
    silver: str = ""
    gold: str = ""
    model: str = ""
    predictions: str = ""
    quarantine: str = ""
    features: str = ""
    quality: str = ""
    blacklist: str = ""
    serve_probability: bool = False
    atomic: bool = False
    bad_records: str = "keep"
    dedup: str = "latest"
    rules: RuleSettings = RuleSettings()
    max_iter: int = 10
    tol: float = 1e-6
    gold_jdbc: JdbcTarget | None = None
    predictions_jdbc: JdbcTarget | None = None

    def __post_init__(self):
        paths = [
            p.rstrip("/")
            for p in (
                self.landing, self.bronze, self.silver, self.gold,
                self.model, self.predictions, self.quarantine, self.features, self.quality, self.blacklist,
            )
            if p
        ]
        if len(paths) != len(set(paths)):
            raise ValueError("every layer needs a path of its own: a job must not overwrite what it reads")
        if self.bad_records not in ("keep", "quarantine"):
            raise ValueError(f"bad_records: {self.bad_records!r}")
        if self.bad_records == "quarantine" and not self.quarantine:
            raise ValueError("bad_records='quarantine' needs a quarantine path")


# Runtime settings the operators rely on at scale.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The list of hot keys is small, but on a large input the stage that
    # finds it runs far longer than the default 300 s.
    "spark.sql.broadcastTimeout": "36000",
}

MIB, GIB = 1 << 20, 1 << 30
MIN_SHUFFLE_PARTITIONS = 200
# 512 MiB each up to 100 TB, beyond that more: every partition is fetched from every map task.
MAX_SHUFFLE_PARTITIONS = 200_000


def sizing_conf(input_bytes: int) -> dict[str, str]:
    """Partition sizes for an input of that many bytes.

    AQE merges small shuffle partitions but does not split large ones, so the
    number must fit the input from the start: about 512 MiB each.  Scan tasks
    grow with the input, from 128 MiB to 1 GiB: at 100 TB these are 100,000.
    """
    shuffles = -(-input_bytes // (512 * MIB))
    shuffles = min(max(shuffles, MIN_SHUFFLE_PARTITIONS), MAX_SHUFFLE_PARTITIONS)
    scan = min(max(input_bytes // 100_000, 128 * MIB), GIB)
    return {
        "spark.sql.shuffle.partitions": str(shuffles),
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
    }


def stored_bytes(spark: SparkSession, path: str) -> int:
    """What lies under a path, by its file system's own summary."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


# Parquet is several times smaller than the rows that are shuffled.
EXPANSION = 4


def size_session(spark: SparkSession, path: str, *, expansion: int = EXPANSION) -> None:
    """Fit the session's partitions to the input, before anything is shuffled."""
    for key, value in sizing_conf(expansion * stored_bytes(spark, path)).items():
        spark.conf.set(key, value)


def spark_conf(store: StoreSettings | None = None, *, input_bytes: int | None = None) -> dict[str, str]:
    """Session settings, to be passed to ``SparkSession.builder.config(map=…)``."""
    conf = dict(ENGINE_CONF)
    if input_bytes is not None:
        conf.update(sizing_conf(input_bytes))
    if store is not None:
        prefix = "spark.hadoop.fs.s3a."
        conf[prefix + "endpoint"] = store.endpoint
        conf[prefix + "access.key"] = store.access_key
        conf[prefix + "secret.key"] = store.secret_key
        conf[prefix + "path.style.access"] = str(store.path_style).lower()
        conf[prefix + "impl"] = "org.apache.hadoop.fs.s3a.S3AFileSystem"
    return conf
