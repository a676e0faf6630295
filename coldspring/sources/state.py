"""Fitted state, tuned settings and result tables on storage (parquet and JSON, no pickles).

A store is a folder of versions and a log of commits. A save writes its tables into a folder of its own and then, as
its last step, one commit file that is put in place by a rename. Readers take the latest commit of each (data set,
stage), so they see whole versions only: a save that dies half-way, or is still running, changes nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldspring.config import EngineConfig
from coldspring.operators import als, content, gather
from coldspring.operators import split as splitting
from coldspring.plans.experiment import Experiment
from coldspring.sources.tables import Dataset
from coldspring.workspace import Workspace


COMMITS = "seq long, token string, dataset string, stage string, folder string, facts string, params map<string,double>"
EXPERIMENT = "experiment"


class Store:
    """Versions of fitted state and settings below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._hadoop_path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        self._files = self._hadoop_path("commits").getFileSystem(spark._jsc.hadoopConfiguration())

    def log(self) -> DataFrame:
        """All commits. Files that are still being written have another name and are not read."""
        if not self._files.exists(self._hadoop_path("commits")):
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).json(f"{self.path}/commits", pathGlobFilter="*.json").filter(F.col("seq").isNotNull())

    def latest(self, dataset: str | None = None) -> list:
        """The last commit of each (data set, stage)."""
        rows = self.log() if dataset is None else self.log().filter(F.col("dataset") == dataset)
        whole = F.struct(*rows.columns)
        return [r.last for r in rows.groupBy("dataset", "stage").agg(F.max_by(whole, F.struct("seq", "token")).alias("last")).collect()]

    def version(self) -> str:
        """A new folder for tables, not yet part of any version."""
        return f"versions/{uuid.uuid4().hex}"

    def commit(self, dataset: str, stage: str, folder: str | None = None, facts: dict | None = None, params: dict | None = None) -> None:
        seq = (self.log().agg(F.max("seq")).first()[0] or 0) + 1
        token = uuid.uuid4().hex
        entry = {"seq": seq, "token": token, "dataset": dataset, "stage": stage, "folder": folder,
                 "facts": None if facts is None else json.dumps(facts), "params": params}
        draft = self._hadoop_path(f"commits/{token}.draft")
        out = self._files.create(draft, False)
        try:
            out.write(bytearray((json.dumps(entry) + "\n").encode()))
        finally:
            out.close()
        if not self._files.rename(draft, self._hadoop_path(f"commits/{seq:012d}-{token}.json")):
            raise OSError(f"commit {seq} of {dataset}/{stage} could not be put in place")

    def remove_unused(self) -> list[str]:
        """Remove the folders of versions that no latest commit names (older ones, and saves that were not finished).
        Not while a save is running."""
        used = {row.folder for row in self.latest() if row.folder}
        root = self._hadoop_path("versions")
        found = [f"versions/{s.getPath().getName()}" for s in self._files.listStatus(root)] if self._files.exists(root) else []
        gone = sorted(set(found) - used)
        for folder in gone:
            self._files.delete(self._hadoop_path(folder), True)
        return gone


def save_experiment(experiment: Experiment, path: str) -> str:
    """Write every fitted table as a new version under ``path``; readers see it once all of it is there."""
    e, store = experiment, Store(experiment.spark, path)
    folder = store.version()
    tables = {"ratings": e.dataset.ratings, "items": e.dataset.items, "users": e.dataset.users, "tags": e.dataset.tags,
              "split": e.split.ratings, "cold_users": e.split.cold_users, "cold_items": e.split.cold_items,
              "user_factors": e.factors.users, "item_factors": e.factors.items, "features": e.features.table,
              "profiles": e.profiles}
    for name, table in tables.items():
        if table is not None:
            table.write.parquet(f"{path}/{folder}/{name}")
    written = [name for name, table in tables.items() if table is not None]
    store.commit(e.dataset.name, EXPERIMENT, folder, {"config": e.cfg.to_json(), "feature_dims": e.features.dims, "tables": written})
    return path


def load_experiment(spark: SparkSession, path: str, workspace: Workspace, dataset: str | None = None) -> Experiment:
    """The last version saved (of ``dataset``, if several are stored here); what is cheap to derive is derived again on
    first use."""
    found = [row for row in Store(spark, path).latest(dataset) if row.stage == EXPERIMENT]
    if len(found) != 1:
        raise FileNotFoundError(f"{path} holds {len(found)} data sets" + ("; name one" if found else ""))
    facts = json.loads(found[0].facts)
    cfg = EngineConfig.from_json(facts["config"])

    def read(name):
        """A table that was saved; one that is lost since is an error."""
        return spark.read.parquet(f"{path}/{found[0].folder}/{name}") if name in facts["tables"] else None

    e = Experiment(Dataset(found[0].dataset, read("ratings"), read("items"), read("users"), read("tags"), stored=True), cfg, workspace)
    e.split = splitting.Split(read("split"), read("cold_users"), read("cold_items"))
    e.features = content.ItemFeatures(read("features"), e.sizes["n_items"], facts["feature_dims"])
    e.profiles = read("profiles")
    vectors = gather.Vectors(read("item_factors"), e.sizes["n_items"], cfg.als.factors, cfg.scale)
    e.factors = als.Factors(read("user_factors"), vectors.table, vectors, als.regularised_gram(vectors, cfg.als))
    return e


def json_safe(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")).alias(n)
                       if isinstance(t, (T.DoubleType, T.FloatType)) else F.col(f"`{n}`") for n, t in kinds.items()])


def write_results(results: dict[str, DataFrame], path: str, cfg: EngineConfig) -> None:
    """One JSON folder per result table, each row with the settings it came from."""
    for name, df in results.items():
        json_safe(df).withColumn("config", F.lit(cfg.to_json())).write.json(f"{path}/{name}")


def save_params(spark: SparkSession, path: str, dataset: str, best: dict[str, dict]) -> None:
    """Commit the best settings per stage ('als', 'blend'); readers take the latest of each, so a
    blend-only search keeps an earlier factor search."""
    store = Store(spark, path)
    for stage, params in best.items():
        store.commit(dataset, stage, params={k: float(v) for k, v in params.items()})


def load_params(spark: SparkSession, path: str, cfg: EngineConfig) -> EngineConfig:
    """``cfg`` with the saved settings of its data set, if there are any."""
    for row in Store(spark, path).latest(cfg.dataset):            # one row per stage
        if row.params:
            current = getattr(cfg, row.stage)
            fields = {k: int(v) if isinstance(getattr(current, k), int) else v for k, v in row.params.items()}
            cfg = replace(cfg, **{row.stage: replace(current, **fields)})
    return cfg


def slice_table(summary: DataFrame, slice_name: str, k: int) -> DataFrame:
    """The headline metrics of one slice."""
    names = [f"precision@{k}", f"recall@{k}", f"ndcg@{k}", f"hit@{k}", "coverage", "novelty", "diversity"]
    return summary.filter(F.col("slice") == slice_name).select("model", *[f"`{n}`" for n in names])
