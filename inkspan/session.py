"""Session helpers: defaults for local use, table access and checkpointing."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "issues", "articles", "page_manifests", "id_envelopes", "test_queries", "eval_passages",
)


def local_session(cpus: int = 8, app: str = "inkspan") -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(SPREAD, str(cpus))
        .getOrCreate()
    )


#: Session setting: into how many partitions tables are dealt out whose queries ask for it. Unset, tables stay as they are.
SPREAD = "spark.inkspan.spread"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """One of the project's Parquet tables; Catalyst prunes and pushes down from here.

    spread: the query does much work for each row, so where the session asks for it, rows are dealt out. That is for
    machines whose cores outnumber a small table's row groups; it shuffles the table, so clusters leave it unset.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get(SPREAD, None)
    return df.repartition(int(parts)) if spread and parts else df


def register(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Registers the tables as temporary views, for SQL users."""
    for n in names:
        if os.path.exists(f"{sf_dir}/{n}.parquet"):
            table(spark, sf_dir, n).createOrReplaceTempView(n)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the cluster's shared folder.

    ``spark.checkpoint.dir`` names that folder. Only where it is unset and the master is local (tests) is a
    temporary one made; elsewhere its absence is an error, since a machine-local folder would not survive.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="inkspan-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package where neither PYTHONPATH nor an installation does.

    The archive is put into the shared checkpoint folder, whatever its file system; only local sessions without that
    setting use a temporary folder. Spark carries it to the executors.
    """
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    if sc.applicationId in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted((root / "inkspan").rglob("*.py")):
            z.write(f, f.relative_to(root))
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share, or PYTHONPATH to this package")
        folder = tempfile.mkdtemp(prefix="inkspan-package-")
    target = f"{folder.rstrip('/')}/inkspan-{sc.applicationId}.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
