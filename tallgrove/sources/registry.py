"""A versioned model registry: model rows of all types below one folder.

A save writes its rows to a folder of its own first and then creates the version's manifest, a small
file that names the folder. The file is created only if it is absent, which the file system decides for
one saver, so of two concurrent saves of a version one fails and its rows are never seen. Readers list the manifests,
by the path alone for one version, and read the named folders.
"""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = (
    "MODEL_NAME string, MODEL_VERSION double, MODEL_TYPE string, ROW_INDEX int, TREE_INDEX int,"
    " MODEL_CONTENT string, KEY string, VALUE string, SAVED_AT timestamp"
)
COLUMNS = [
    "MODEL_NAME", "MODEL_VERSION", "MODEL_TYPE", "ROW_INDEX", "TREE_INDEX", "MODEL_CONTENT", "KEY", "VALUE",
    "MODEL_DATE", "MODEL_TIME",
]

# Model types and the version a champion is stored under.
FOREST, BOOSTED, TREE = "RDT", "GBDT", "DT"
CHAMPION_VERSION = 99.9


class Registry:
    """Model rows by (name, version, type) in a folder all executors can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def table(self) -> DataFrame:
        """All rows, with date and time of saving."""
        return self._stored().select(
            *COLUMNS[:-2],
            F.to_date("SAVED_AT").alias("MODEL_DATE"),
            F.date_format("SAVED_AT", "HH:mm:ss").alias("MODEL_TIME"),
        )

    @classmethod
    def create(cls, spark: SparkSession, path: str) -> Registry:
        """An empty registry at a path that is not in use yet."""
        registry = cls(spark, path)
        files, place = registry._place("manifests")
        if files.exists(place.getParent()):
            raise ValueError(f"{path} is in use")
        files.mkdirs(place)
        return registry

    def _place(self, *parts: str):
        """The file system of a path below the registry, and the path."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path.rstrip("/"), *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _manifest(self, name: str, version: float | str, model_type: str) -> str:
        return "=".join(quote(x, safe="") for x in (name, repr(float(version)), model_type))

    def _folders(self, files, manifests) -> list[str]:
        found = []
        for path in manifests:
            stream = files.open(path)
            try:
                found.append(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()
        return found

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*[f"{self.path.rstrip('/')}/rows/{f}" for f in folders])

    def _stored(self) -> DataFrame:
        files, place = self._place("manifests")
        return self._read(self._folders(files, [s.getPath() for s in files.listStatus(place)]))

    def _version(self, name: str, version: float | str, model_type: str) -> DataFrame:
        files, path = self._place("manifests", self._manifest(name, version, model_type))
        return self._read(self._folders(files, [path]) if files.exists(path) else [])

    def stage(
        self,
        name: str,
        version: float | str,
        model_type: str,
        rows: DataFrame,
        saved_at: dt.datetime | None = None,
    ) -> str:
        """Write the rows of a model where no reader looks; columns its layout lacks stay NULL. Returns their folder."""
        stamp = F.lit(saved_at) if saved_at else F.current_timestamp()

        def column(name: str, kind: str):
            return (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)

        folder = f"{self._manifest(name, version, model_type)}-{uuid.uuid4().hex}"
        rows.select(
            F.lit(name).alias("MODEL_NAME"),
            F.lit(float(version)).alias("MODEL_VERSION"),
            F.lit(model_type).alias("MODEL_TYPE"),
            column("ROW_INDEX", "int"),
            column("TREE_INDEX", "int"),
            *[column(c, "string") for c in ("MODEL_CONTENT", "KEY", "VALUE")],
            stamp.alias("SAVED_AT"),
        ).write.mode("errorifexists").parquet(f"{self.path.rstrip('/')}/rows/{folder}")
        return folder

    def commit(self, name: str, version: float | str, model_type: str, folder: str) -> None:
        """Make staged rows the version's rows, unless the version has rows; then the staged ones are removed."""
        files, path = self._place("manifests", self._manifest(name, version, model_type))
        try:
            stream = files.create(path, False)  # fails if the file is there
        except Exception as error:
            files, rows = self._place("rows", folder)
            files.delete(rows, True)
            raise ValueError(f"{name} {version} {model_type} is already saved") from error
        try:
            stream.write(bytearray(folder.encode()))
        finally:
            stream.close()

    def save(
        self,
        name: str,
        version: float | str,
        model_type: str,
        rows: DataFrame,
        saved_at: dt.datetime | None = None,
    ) -> None:
        """Add a version; a version is saved once, also if two sessions save it at the same time."""
        files, path = self._place("manifests", self._manifest(name, version, model_type))
        if files.exists(path):  # spares the writing; the commit decides
            raise ValueError(f"{name} {version} {model_type} is already saved")
        self.commit(name, version, model_type, self.stage(name, version, model_type, rows, saved_at))

    def load(self, name: str, version: float | str, model_type: str) -> DataFrame:
        """The model rows in the layout of their type."""
        rows = self._version(name, version, model_type)
        if model_type == BOOSTED:
            return rows.select("ROW_INDEX", "KEY", "VALUE")
        if model_type == TREE:
            return rows.select("ROW_INDEX", "MODEL_CONTENT")
        return rows.select("ROW_INDEX", "TREE_INDEX", "MODEL_CONTENT")

    def latest(self, name: str, *model_types: str) -> tuple[float, str] | None:
        """(version, type) of the greatest version saved, from the manifests alone; of equal versions the first type given.

        Without types all of them count, in alphabetical order.
        """
        files, place = self._place("manifests")
        found = []
        for status in files.listStatus(place):
            of, version, kind = map(unquote, status.getPath().getName().split("="))
            if of == name and (kind in model_types or not model_types):
                found.append((float(version), kind))
        order = model_types or sorted({kind for _, kind in found})
        return max(found, key=lambda f: (f[0], -order.index(f[1])), default=None)

    def versions(self, name: str | None = None, above: float | None = None) -> DataFrame:
        """Distinct saved versions with date and time."""
        listed = self.table()
        if name is not None:
            listed = listed.filter(F.col("MODEL_NAME") == name)
        if above is not None:
            listed = listed.filter(F.col("MODEL_VERSION") > above)
        return listed.select("MODEL_NAME", "MODEL_VERSION", "MODEL_TYPE", "MODEL_DATE", "MODEL_TIME").distinct()

    def save_champion(
        self, name: str, choice: str, first: tuple[str, DataFrame], second: tuple[str, DataFrame], **more
    ) -> str:
        """Save the chosen one of two ``(type, rows)`` as champion; returns its type."""
        model_type, rows = first if choice == "a" else second
        self.save(name, CHAMPION_VERSION, model_type, rows, **more)
        return model_type
