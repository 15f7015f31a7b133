"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR is the table folder (default sf0.1), BENCH_CPUS the number of local threads (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chatterlens.operators.models import compare_models, split_by_hash  # noqa: E402
from chatterlens.plans.catalogue import QUERIES  # noqa: E402
from chatterlens.plans.fixtures import labelled, table  # noqa: E402
from chatterlens.plans.learning import fitted  # noqa: E402
from chatterlens.session import local_session  # noqa: E402

TIMED = (
    "message_sentiment_over_time",
    "decoded_messages",
    "valid_messages_stamped",
    "validation_problems",
    "cleaned_text",
    "sentiment_per_five_minutes",
    "sentiment_distribution",
    "top_users",
    "top_message_texts",
    "trending_message_words",
    "newest_messages_per_user",
    "upsert_by_hour",
    "prediction_quality",
    "corpus_vocabulary",
    "document_weights",
    "messages_scored",
    "messages_scored_by_plugin",
    "stream_validated_and_routed",
    "stream_scored_to_two_sinks",
    "stream_repeats_dropped",
    "stream_live_sentiment",
)


def timed(work: Callable[[], object]) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="chatterlens-bench")
    events = table(spark, folder, "events").count()

    def write_away(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    write_away("row_counts")  # starts the session
    seconds = {"train_naive_bayes": timed(lambda: fitted(spark, folder))}
    for name in TIMED:
        seconds[name] = timed(lambda: write_away(name))
    compared = []
    train_rows, test_rows = split_by_hash(labelled(spark, folder), "doc_id")
    seconds["models_compared"] = timed(lambda: compared.extend(compare_models(train_rows, test_rows).collect()))
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
                "messages": events,
                "messages_per_second": {
                    name: round(events / seconds[name])
                    for name in ("valid_messages_stamped", "messages_scored", "messages_scored_by_plugin")
                },
                "training_seconds": {row.model: round(row.training_time, 2) for row in compared},
                "fit_seconds": {row.model: round(row.fit_time, 2) for row in compared},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
