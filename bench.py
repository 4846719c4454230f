"""Time the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from webtext.plans.registry import QUERIES  # noqa: E402
from webtext.session import build_session  # noqa: E402

HEADLINE = [
    "page_articles",
    "page_links",
    "match_bm25",
    "match_total",
    "clean_text",
    "word_hist",
    "final_text",
    "train_test_split",
    "tfidf_train",
    "bow_counts",
    "mean_embedding",
    "nb_predictions",
    "roc_auc",
    "log_route",
    "log_daily_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    # The first runs compile; the best of three counts.
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    seconds = {name: round(min(run(name) for _ in range(3)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
