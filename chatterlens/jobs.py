"""The jobs as commands for spark-submit: compare classifiers, validate a topic, score a topic, index and search texts.

    spark-submit --py-files chatterlens.zip chatterlens/jobs.py compare --comments comments.csv --models /models
    ... validate --servers kafka:9092 --input raw --valid checked --dead /dead --checkpoint /checkpoints/validate
    ... score --servers kafka:9092 --input checked --model /models/Naive_Bayes_model --documents /documents
        --dead /unscored --results scored --checkpoint /checkpoints/score
    ... index --documents /texts --index /index --segment 2024-01-01
    ... search --index /index --words "late delivery"

Without ``--servers`` topics are folders of JSON lines. ``chatterlens.zip`` holds this package.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from chatterlens.functions.text import drop_empty_text, with_clean_text
from chatterlens.operators import dashboards, models, quality, search
from chatterlens.operators.keyed_table import KeyedTable
from chatterlens.operators.validate import decode_messages
from chatterlens.session import prepare
from chatterlens.sources.tables import read_labelled_csv
from chatterlens.sources.topics import read_messages
from chatterlens.streaming import jobs, runner, sinks


def compare(spark: SparkSession, options: argparse.Namespace) -> None:
    """Train and rank the classifiers on labelled comments; write the models and their metrics."""
    comments = read_labelled_csv(spark, options.comments, multi_line=not options.one_line)
    comments = with_clean_text(drop_empty_text(comments, "Comment"), "Comment")
    dashboards.distribution(comments, "Sentiment").show()
    # Equal comments fall into the same part, so that none is tested on what it was trained with.
    split = models.split_at_random if options.random_split else lambda rows: models.split_by_hash(rows, "Comment")
    train_rows, test_rows = split(comments)
    metrics = models.compare_models(
        train_rows, test_rows, save_to=options.models, parallelism=options.parallel, inspect=_show_predictions
    )
    models.save_metrics(metrics, f"{options.models}/comparison_results")
    quality.rank_models(metrics).show(truncate=False)
    quality.rank_models(metrics, "f1_score").show(truncate=False)
    quality.model_outcomes(metrics).show()


def _show_predictions(model: str, predicted: DataFrame) -> None:
    """Print a model's confusion matrix and five of its predictions."""
    print(model)
    quality.confusion_matrix(predicted).orderBy("label", "prediction").show()
    dashboards.preview(predicted, ["Comment", "Sentiment", "prediction"], "Comment").show(truncate=False)


def _topic(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    fmt = "kafka" if options.servers else "text"
    limits = options.max_per_trigger, options.max_bytes
    values = read_messages(spark, fmt, options.input, options.servers, options.starting, limits[0], max_bytes=limits[1])
    return jobs.unique_values(values, options.unique_for) if options.unique_for else values


def _topic_sink(options: argparse.Namespace, target: str) -> sinks.BatchWriter:
    return sinks.kafka_topic(options.servers, target) if options.servers else sinks.topic_folder(target)


def _trigger(options: argparse.Namespace) -> str | None:
    return runner.AVAILABLE_NOW if options.once else options.trigger


def validate(spark: SparkSession, options: argparse.Namespace) -> None:
    """Send the valid messages of a topic to another topic and the others to the dead-letter table."""
    valid, dead = _topic_sink(options, options.valid), sinks.batch_folder(options.dead)
    with runner.progress_logged(spark, options.progress) if options.progress else nullcontext():
        queries = [jobs.validate_stream(_topic(spark, options), valid, dead, options.checkpoint, _trigger(options))]
        if options.console:
            queries.append(runner.start_console(decode_messages(_topic(spark, options)), options.trigger))
        runner.run(queries)


def score(spark: SparkSession, options: argparse.Namespace) -> None:
    """Score the messages of a topic; write keyed documents, dead letters and, if asked for, a topic or an index."""
    if options.keyed:
        results = KeyedTable(spark, options.documents, dimensions=("source", "sentiment"))
        writers = [sinks.keyed_documents(results)]
    else:
        writers = [jobs.document_log(options.documents)]
    if options.results:
        writers.append(sinks.derived(_topic_sink(options, options.results), lambda batch: batch.drop("arrival")))
    if options.index:
        writers.append(sinks.external_table("es", sinks.search_index_options(options.index)))
    model, dead = models.load_model(options.model), sinks.batch_folder(options.dead)
    query = jobs.score_topic_stream(_topic(spark, options), model, writers, dead, options.checkpoint, _trigger(options))
    runner.run([query])


def index(spark: SparkSession, options: argparse.Namespace) -> None:
    """Index the texts of a Parquet folder as one segment of a search index."""
    search.write_segment(spark.read.parquet(options.documents), options.index, options.segment, options.key, options.text)


def find(spark: SparkSession, options: argparse.Namespace) -> None:
    """Print the best documents of a search index for some words."""
    search.search(spark, options.index, [options.words], options.most).orderBy("rank").show(options.most, truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="chatterlens")
    commands = parser.add_subparsers(required=True)

    command = commands.add_parser("compare", help=compare.__doc__)
    command.set_defaults(run=compare)
    command.add_argument("--comments", required=True, help="CSV with the columns Comment and Sentiment")
    command.add_argument("--one-line", action="store_true", help="no comment holds a line break, so files may be split")
    command.add_argument("--models", required=True, help="folder for the models and their metrics")
    command.add_argument("--random-split", action="store_true", help="split at random instead of by comment")
    command.add_argument("--parallel", type=int, default=1, help="classifiers trained at a time")

    topic = argparse.ArgumentParser(add_help=False)
    topic.add_argument("--servers", help="Kafka servers; without them topics are folders")
    topic.add_argument("--input", required=True)
    topic.add_argument("--starting", default="earliest", choices=["earliest", "latest"])
    topic.add_argument("--max-per-trigger", type=int, help="messages (Kafka) or files (folder) per batch")
    topic.add_argument("--max-bytes", type=int, help="bytes of a folder per batch, instead of files")
    topic.add_argument("--checkpoint", required=True)
    topic.add_argument("--trigger", help="interval such as '5 seconds'; default: as fast as possible")
    topic.add_argument("--once", action="store_true", help="work off what is there and stop")
    topic.add_argument("--unique-for", help="drop values that came before within this time, such as '10 minutes'")
    topic.add_argument("--dead", required=True, help="dead-letter table")

    command = commands.add_parser("validate", help=validate.__doc__, parents=[topic])
    command.set_defaults(run=validate)
    command.add_argument("--valid", required=True)
    command.add_argument("--progress", help="folder for one record per batch")
    command.add_argument("--console", action="store_true", help="print the decoded messages too")

    command = commands.add_parser("score", help=score.__doc__, parents=[topic])
    command.set_defaults(run=score)
    command.add_argument("--model", required=True)
    command.add_argument("--documents", required=True)
    command.add_argument("--results", help="topic for the results")
    command.add_argument("--index", help="search index for the results")
    command.add_argument("--keyed", action="store_true", help="keep the documents as a keyed table with counts, not as a log")

    command = commands.add_parser("index", help=index.__doc__)
    command.set_defaults(run=index)
    command.add_argument("--documents", required=True, help="Parquet folder")
    command.add_argument("--index", required=True)
    command.add_argument("--segment", required=True, help="name of this part of the index; a part of that name is replaced")
    command.add_argument("--key", default="id", help="column that tells documents apart")
    command.add_argument("--text", default="text", help="column to index")

    command = commands.add_parser("search", help=find.__doc__)
    command.set_defaults(run=find)
    command.add_argument("--index", required=True)
    command.add_argument("--words", required=True)
    command.add_argument("--most", type=int, default=10, help="documents to show")
    return parser


def main(arguments: Sequence[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    options.run(prepare(SparkSession.builder.appName("chatterlens").getOrCreate()), options)


if __name__ == "__main__":
    main()
