"""Time the whole pipeline (train, evaluate, analyse) and some single queries.

Prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. The pipeline
uses the default settings (128 factors, 12 rounds, text embedding, 8 models), i.e. those of
the published run times; its steps are timed one after the other in a fresh session.
"""

import json
import os
import time

for _name in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS"):
    os.environ.setdefault(_name, "1")

from pyspark.sql import functions as F  # noqa: E402

from coldspring.config import EngineConfig  # noqa: E402
from coldspring.operators import interactions  # noqa: E402
from coldspring.plans import analysis, evaluate, serving  # noqa: E402
from coldspring.plans.experiment import Experiment  # noqa: E402
from coldspring.sources.tables import load_tables, rating_rows  # noqa: E402
from coldspring.workspace import Workspace, local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cores, name="coldspring-bench")
    times: dict[str, float] = {}

    def timed(name, run):
        start = time.time()
        out = run()
        times[name] = round(time.time() - start, 3)
        return out

    workspace, cfg = Workspace(spark), EngineConfig()
    e = timed("load", lambda: Experiment(load_tables(spark, folder), cfg, workspace))
    timed("split", lambda: e.split)
    timed("history", lambda: (e.train_pairs, e.user_stats, e.item_stats, e.liked, e.sizes))
    timed("popularity", lambda: (e.popularity_vectors, e.percentiles))
    timed("text_embedding", lambda: e.embedding)
    timed("item_features", lambda: e.features)
    timed("user_profiles", lambda: e.profiles)
    timed("als_fit", lambda: e.factors)
    timed("catalog_state", lambda: (e.catalog, e.moments, e.user_state))
    results = timed("evaluate", lambda: evaluate.evaluate(e))
    timed("analysis", lambda: [df.collect() for df in analysis.run_analysis(e, results).values()])
    total = sum(times.values())

    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    timed("q_interactions_collapse", lambda: noop(interactions.collapse(rating_rows(spark, folder))))
    timed("q_similar_items", lambda: noop(analysis.similar_items(e, 10)))
    timed("q_user_history", lambda: noop(serving.user_history(e)))
    timed("q_pair_signals", lambda: noop(evaluate.pair_signals(e, e.dataset.ratings.select("user_id", "item_id"))))
    timed("q_request_lists", lambda: noop(serving.recommend_users(
        e, e.user_stats.filter(F.col("user_id") % 10 == 0), e.sizes["n_users"] // 10, ["adaptive"], 10)))
    print(json.dumps({"metric": "train_evaluate_analyse", "value": round(total, 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
