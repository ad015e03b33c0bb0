"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.plans.catalog import QUERIES
from marquee.session import local_session

HEADLINE = (
    "submission", "feature_table", "load_ratings", "profile_numeric", "counts_by_key", "genre_combo_stats",
    "genre_stats", "group_size_summary", "top_n_ties", "corr_matrix", "enc_user_genre_15", "enc_user_index_v5",
    "enc_item_index_v3", "join_item_index", "enc_oof", "impute_mean", "split_exact", "kfold_assign",
    "movie_stats_sql", "normalize_ratings", "ibcf_neighbours", "ibcf_predict", "ubcf_predict",
    "top_n_recommend", "ols_model0", "rf_predict", "als_predict", "pair_association", "ubcf_neighbours",
    "submission_boosted", "gbt_predict", "linear_cv", "ols_ladder", "model_leaderboard",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=max(8, int(cores)) if cores.isdigit() else 8, app="bench")
    names = sys.argv[1:] or HEADLINE
    QUERIES["load_ratings"](spark, sf_dir).count()  # start-up is not part of any query
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{times[name]:8.2f}s {name}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cores,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
