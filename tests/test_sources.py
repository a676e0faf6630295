import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from coldspring.config import EngineConfig
from coldspring.operators import split as splitting
from coldspring.sources import movielens, state
from coldspring.sources.tables import Dataset, load_tables
from coldspring.plans import evaluate
from coldspring.workspace import Workspace, checkpoint_root
from tests.conftest import SMALL


def write(folder, name, text, encoding="utf-8"):
    (folder / name).write_bytes(text.encode(encoding))


def test_dat_layout(spark, tmp_path):
    write(tmp_path, "ratings.dat", "1::10::5::978300760\n2::11::3::978300761\n2::99::1::978300762\n")
    write(tmp_path, "movies.dat", '10::Misérables, Les "x" (1995)::Drama|Musical\n11::Fish, A (1988)::Comedy\n', "latin-1")
    write(tmp_path, "users.dat", "1::F::1::10::48067\n2::M::56::16::70072\n")
    data = movielens.load_dat(spark, str(tmp_path))
    items = {r.item_id: r for r in data.items.collect()}
    assert items[10].title == 'Misérables, Les "x"' and items[10].year == 1995 and items[10].genres == ["Drama", "Musical"]
    assert items[11].title == "A Fish"
    assert sorted(r.item_id for r in data.ratings.collect()) == [10, 11]          # 99 is not in the catalog
    assert data.users.columns == ["user_id", "gender", "age", "occupation"] and data.tags is None


def test_csv_layout(spark, tmp_path):
    write(tmp_path, "ratings.csv", "userId,movieId,rating,timestamp\n1,1,4.5,964982703\n1,3,4.0,964981247\n")
    write(tmp_path, "movies.csv", 'movieId,title,genres\n1,"Market at Noon, The (1995)",Comedy|Drama\n'
                                  '2,"He said ""no""",(no genres listed)\n')
    write(tmp_path, "tags.csv", "userId,movieId,tag,timestamp\n1,1,Funny Stuff,1\n2,1,POLITICS,2\n")
    data = movielens.load_csv(spark, str(tmp_path))
    items = {r.item_id: r for r in movielens.with_tags(data.items, data.tags).collect()}
    assert items[1].title == "The Market at Noon" and items[1].tags == "funny stuff politics"
    assert items[2].title == 'He said "no"' and items[2].year is None and items[2].genres == [] and items[2].tags == ""
    assert [r.item_id for r in data.ratings.collect()] == [1] and data.users is None


def test_missing_files_are_named(spark, tmp_path):
    write(tmp_path, "ratings.dat", "1::10::5::978300760\n")
    with pytest.raises(FileNotFoundError, match="movies.dat, users.dat"):
        movielens.load_dat(spark, str(tmp_path))


def test_state_round_trip(spark, experiment, tmp_path):
    path = state.save_experiment(experiment, str(tmp_path / "state"))
    again = state.load_experiment(spark, path, Workspace(spark))
    assert again.cfg == experiment.cfg
    users = experiment.user_stats.limit(9)
    lists = [sorted(map(tuple, evaluate.ranked(e, users, e.models(), 5, "x").select("model", "user_id", "rank", "item_id").collect()))
             for e in (experiment, again)]
    assert lists[0] == lists[1]
    written = os.listdir(again.workspace.root.removeprefix("file:"))
    assert not [name for name in written if name.split("-", 1)[1] in ("ratings", "items", "users", "tags", "split")]      # no copy of the inputs
    folder = state.Store(spark, path).latest()[0].folder
    os.rename(f"{path}/{folder}/users", f"{path}/{folder}/users-lost")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        state.load_experiment(spark, path, Workspace(spark))


def test_a_save_that_dies_leaves_the_old_version(spark, experiment, tmp_path):
    path = str(tmp_path / "versions")
    with pytest.raises(FileNotFoundError):
        state.load_experiment(spark, path, Workspace(spark))
    state.save_experiment(experiment, path)
    first = state.Store(spark, path).latest()[0]

    class Dies:
        """The saved experiment up to its features; then the machine is gone."""
        def __getattr__(self, name):
            if name == "profiles":
                raise KeyboardInterrupt
            return getattr(experiment, name)

    half = Dies()
    with pytest.raises(KeyboardInterrupt):
        state.save_experiment(half, path)
    broken = state.Store(spark, path)
    folder = broken.version()
    experiment.item_stats.write.parquet(f"{path}/{folder}/items")            # tables without a commit
    (tmp_path / "versions" / "commits" / "abc.draft").write_text('{"seq": 99, "dataset": "fix')      # a commit half written
    assert [r.folder for r in state.Store(spark, path).latest()] == [first.folder]
    again = state.load_experiment(spark, path, Workspace(spark))
    assert again.dataset.items.count() == 40 and again.profiles.count() == experiment.profiles.count()

    state.save_experiment(experiment, path)
    last = state.Store(spark, path).latest()[0]
    assert last.seq == first.seq + 1 and last.folder != first.folder
    assert first.folder in broken.remove_unused() and sorted(os.listdir(f"{path}/versions")) == [last.folder.split("/")[1]]
    assert state.load_experiment(spark, path, Workspace(spark), "fixture").dataset.items.count() == 40


def test_config_round_trip():
    assert EngineConfig.from_json(SMALL.to_json()) == SMALL


def test_params_are_kept_per_stage(spark, tmp_path):
    path = str(tmp_path / "params")
    cfg = EngineConfig(dataset="d")
    assert state.load_params(spark, path, cfg) == cfg
    state.save_params(spark, path, "d", {"als": {"factors": 32, "alpha": 0.25}, "blend": {"k_user": 3.0}})
    state.save_params(spark, path, "other", {"blend": {"k_user": 7.0}})
    state.save_params(spark, path, "d", {"blend": {"k_user": 10.0}})
    got = state.load_params(spark, path, cfg)
    assert got.als.factors == 32 and got.als.alpha == 0.25 and got.blend.k_user == 10.0


def test_results_are_json_safe(spark, tmp_path):
    df = spark.createDataFrame([("a", float("nan")), ("b", 1.5)], "model string, v double")
    state.write_results({"t": df}, str(tmp_path), SMALL)
    rows = [json.loads(line) for f in (tmp_path / "t").glob("*.json") for line in f.read_text().splitlines()]
    assert {r["model"]: r.get("v") for r in rows} == {"a": None, "b": 1.5}


def test_checkpoint_folder_comes_from_the_session():
    class Conf(dict):
        pass

    class Session:
        def __init__(self, master, **conf):
            self.conf = Conf(conf)
            self.sparkContext = type("Context", (), {"master": master, "getConf": lambda _, c=self.conf: c})()

    shared = {"spark.checkpoint.dir": "hdfs:///shared/checkpoints/"}
    assert checkpoint_root(Session("spark://host", **shared)) == "hdfs:///shared/checkpoints"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session("spark://host"))
    assert checkpoint_root(Session("local[2]")).startswith(tempfile.gettempdir())


def test_rows_that_do_not_fit_are_an_error(spark, tmp_path):
    write(tmp_path, "movies.csv", "movieId,title,genres\n1,Some (1990),Drama\n")
    write(tmp_path, "tags.csv", "userId,movieId,tag,timestamp\n")
    write(tmp_path, "ratings.csv", "userId,movieId,rating,timestamp\n1,1,4.5,964982703\nx,1,bad,9\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        movielens.load_csv(spark, str(tmp_path)).ratings.collect()


def test_table_adapter_drops_ratings_of_unknown_parts(spark, tmp_path):
    frames = {"part": [(1, "p", 5, "T", "B")], "orders": [(10, 7, dt.datetime(2020, 1, 1))], "lineitem": [(10, 1, 5.0), (10, 2, 5.0)],
              "nation": [(0, 3)], "customer": [(7, "BUILDING", 0)]}
    columns = {"part": "p_partkey long, p_name string, p_size int, p_type string, p_brand string", "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp",
               "lineitem": "l_orderkey long, l_partkey long, l_quantity double", "nation": "n_nationkey int, n_regionkey int",
               "customer": "c_custkey long, c_mktsegment string, c_nationkey int"}
    for name, rows in frames.items():
        spark.createDataFrame(rows, columns[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert [(r.user_id, r.item_id, r.rating) for r in load_tables(spark, str(tmp_path)).ratings.collect()] == [(7, 1, 1.0)]


def test_sample_keeps_rows_of_drawn_users_only(spark, frames, workspace):
    drawn = splitting.sample_users(Dataset("fixture", *frames, None), 7, 3, SMALL.scale, workspace)
    ids = {r.user_id for r in drawn.ratings.select("user_id").collect()}
    assert len(ids) == 7 and {r.user_id for r in drawn.users.collect()} == ids and drawn.items.count() == 40
    assert drawn.ratings.count() == frames[0].filter(F.col("user_id").isin(*ids)).count()


def test_slice_table(spark):
    names = ["precision@3", "recall@3", "ndcg@3", "hit@3", "coverage", "novelty", "diversity"]
    rows = [("warm", "a", 4, *[0.5] * 7), ("cold", "a", 2, *[0.25] * 7), ("cold", "b", 2, *[0.75] * 7)]
    summary = spark.createDataFrame(rows, ["slice", "model", "users", *names])
    out = state.slice_table(summary, "cold", 3)
    assert out.columns == ["model", *names] and sorted(map(tuple, out.collect())) == [("a", *[0.25] * 7), ("b", *[0.75] * 7)]


def test_a_closed_workspace_leaves_nothing(spark):
    workspace = Workspace(spark)
    workspace.stage(spark.range(5), "some")
    assert os.path.isdir(workspace.root.removeprefix("file:"))
    workspace.close()
    assert not os.path.exists(workspace.root.removeprefix("file:"))
