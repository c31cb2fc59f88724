"""Registry of the master-data tables a rule reads (name -> DataFrame).

Rules never open files themselves; they take a ``Tables`` object. In
production the registry points at the warehouse views (catalog tables or
parquet/Delta paths); in tests and benchmarks it derives the views from the
driver's parquet (``from_tpch``). ``materialize`` writes every table once to a
shared folder, which cuts lineage and lets many rules scan the same files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession

from mdq.sources import contract, erp_fixtures, views

TABLE_NAMES = erp_fixtures.NAMES
SHARED_VIEWS = tuple(views.DERIVED)


class Tables:
    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}
        self._raw: dict[str, tuple] = {}              # name -> (source as it comes, its mapping)
        self._seen: dict[str, Observation] = {}
        self._lost: list[DataFrame] = []

    # -- constructors -----------------------------------------------------
    @classmethod
    def from_tpch(cls, spark: SparkSession, sf_dir: str, share: bool = False) -> "Tables":
        """``share`` (for many rules in one query): see ``erp_fixtures.spark_bases``."""
        bases = erp_fixtures.spark_bases(spark, sf_dir, share)
        loaders = {n: (lambda n=n: erp_fixtures.derive(bases[n](), n)) for n in TABLE_NAMES}
        return cls(spark, loaders)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str | dict[str, str],
                     mapping: dict[str, dict[str, str]] | None = None) -> "Tables":
        """Parquet folders ``<root>/<name>``, or a path for each name, held to
        the source contract. ``mapping``: table -> contract column -> its name."""
        paths = root if isinstance(root, dict) else {n: f"{root}/{n}" for n in TABLE_NAMES}
        return cls._held(spark, {n: (lambda p=p: spark.read.parquet(p)) for n, p in paths.items()}, mapping)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: dict[str, str],
                     mapping: dict[str, dict[str, str]] | None = None) -> "Tables":
        """Catalog tables, each by its own full name (any schema), held to the contract."""
        return cls._held(spark, {n: (lambda t=t: spark.table(t)) for n, t in names.items()}, mapping)

    @classmethod
    def _held(cls, spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], mapping) -> "Tables":
        out, m = cls(spark, {}), mapping or {}

        def load(n):
            raw = sources[n]()
            out._raw[n] = (raw, m.get(n))
            return contract.apply(raw, n, m.get(n))
        out._loaders = {n: (lambda n=n: load(n)) for n in sources}
        return out

    # -- access -----------------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in self._loaders:
                self._frames[name] = self._loaders[name]()
            elif name in views.DERIVED:
                self._frames[name] = views.DERIVED[name](self)
            else:
                raise KeyError(f"no source registered for table {name!r}")
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name == "spark":
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError as e:
            raise AttributeError(name) from e

    def materialize(self, root: str | None = None, names=None) -> "Tables":
        """Write each table (and the shared views) once as parquet under
        ``root`` (default: a fresh folder inside the session's checkpoint
        directory, which a cluster places on shared storage) and return a
        registry that reads the written files. This cuts the lineage: a
        lost executor recomputes from these files, not from the sources.
        Shared views are computed from the written base tables.

        Values that the contract cannot read are counted while the tables are
        written and, where there are any, kept under ``<root>/_quarantine``
        (``source_report``, ``quarantined`` of the result)."""
        if root is None:
            from mdq.session import shared_path
            root = shared_path(self.spark, "mdq-tables")
        if names is None:
            names = tuple(n for n in TABLE_NAMES + SHARED_VIEWS if n in self._loaders or n in views.DERIVED)
        base = [n for n in names if n not in views.DERIVED]
        seen, lost = {}, []
        for n in base:
            df = self[n]
            if n in self._raw:
                raw, mapping = self._raw[n]
                seen[n] = Observation(f"source {n}")
                df = contract.apply(raw, n, mapping, seen[n])
            df.write.mode("overwrite").parquet(f"{root}/{n}")
            if n in seen and any(v for c, v in seen[n].get.items() if c != "rows"):
                contract.quarantine(raw, n, mapping).write.mode("overwrite").parquet(f"{root}/_quarantine/{n}")
                lost.append(self.spark.read.parquet(f"{root}/_quarantine/{n}"))
        written = Tables.from_parquet(self.spark, {n: f"{root}/{n}" for n in base})
        for n in names:
            if n in views.DERIVED:
                written[n].write.mode("overwrite").parquet(f"{root}/{n}")
        out = Tables.from_parquet(self.spark, {n: f"{root}/{n}" for n in names})
        out._seen, out._lost = seen, lost
        return out

    # -- what the contract could not read ----------------------------------
    def source_report(self) -> DataFrame:
        """SOURCE, COLUMN_NAME, ROWS and UNREADABLE of every column that was read
        from another type when these tables were written; a source that needed
        no reading has one row, without a column name."""
        rows = []
        for n, o in self._seen.items():
            counts = dict(o.get)
            total = counts.pop("rows")
            rows += [(n, c, total, v) for c, v in counts.items()] or [(n, None, total, 0)]
        return self.spark.createDataFrame(rows, "SOURCE string, COLUMN_NAME string, ROWS bigint, UNREADABLE bigint")

    def quarantined(self) -> DataFrame:
        """The values kept aside when these tables were written."""
        if not self._lost:
            return self.spark.createDataFrame([], "SOURCE string, COLUMN_NAME string, VALUE string, REASON string, ROW_KEY map<string,string>")
        return reduce(DataFrame.unionByName, self._lost)
