"""The commands, one after the other on folders, as a user would run them."""

import json

import pytest
from conftest import values

from chatterlens import jobs
from chatterlens.operators import models
from chatterlens.operators.keyed_table import KeyedTable
from chatterlens.operators.latest import read_log, upsert_view
from chatterlens.functions.text import with_clean_text
from chatterlens.sources.tables import CSV_OPTIONS
from chatterlens.streaming.runner import progress_table

POSITIVE = ["love this phone", "great video, thanks", "what a great day", "best thing ever", "really love it"]
NEGATIVE = ["hate this ad", "worst video ever", "this is awful", "so bad", "I hate the lag"]


def test_train_validate_and_score(spark, rows, tmp_path, monkeypatch):
    comments = [(f"{t}\nno {i}", "positive") for i in range(8) for t in POSITIVE]
    comments += [(f"{t} {i}", "negative") for i in range(8) for t in NEGATIVE] + [("...", "neutral")]
    rows(comments, "Comment string, Sentiment string").write.options(**CSV_OPTIONS).csv(str(tmp_path / "csv"))
    chosen = {name: c for name, c in models.classifiers().items() if name in ("Naive_Bayes", "Decision_Tree")}
    monkeypatch.setattr(models, "classifiers", lambda: chosen)
    jobs.main(["compare", "--comments", str(tmp_path / "csv"), "--models", str(tmp_path / "models")])
    metrics = models.read_metrics(spark, str(tmp_path / "models" / "comparison_results"))
    assert {r.model: r.error for r in metrics.collect()} == {"Naive_Bayes": None, "Decision_Tree": None}

    sent = [{"text": t, "user": "u", "timestamp": "2024-01-01T00:00:00Z", "location": "x"} for t in ("I love it", "hate", "")]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a").write_text("\n".join([*map(json.dumps, sent), "broken"]) + "\n")
    place = {name: str(tmp_path / name) for name in ("raw", "valid", "dead", "cp1", "cp2", "documents", "results", "progress", "unscored")}
    jobs.main(
        ["validate", "--input", place["raw"], "--valid", place["valid"], "--dead", place["dead"]]
        + ["--checkpoint", place["cp1"], "--once", "--progress", place["progress"]]
    )
    assert sorted(values(spark.read.parquet(place["dead"]), "reason")) == ["malformed_json", "missing_text"]
    jobs.main(
        ["score", "--input", place["valid"], "--model", str(tmp_path / "models" / "Naive_Bayes_model")]
        + ["--documents", place["documents"], "--results", place["results"], "--checkpoint", place["cp2"], "--once"]
        + ["--dead", place["unscored"], "--unique-for", "10 minutes"]
    )
    documents = upsert_view(read_log(spark, place["documents"]))
    assert values(documents.select("text", "sentiment")) == [("I love it", "positive"), ("hate", "negative")]
    assert spark.read.text(place["results"]).count() == 2
    assert progress_table(spark, place["progress"]).agg({"input_rows": "sum"}).first()[0] == 4


def test_score_keeps_dead_letters_and_drops_repeats(spark, rows, tmp_path):
    comments = rows([("good", "positive"), ("bad", "negative")], "Comment string, Sentiment string")
    models.save_model(models.train(with_clean_text(comments, "Comment"), models.classifiers()["Naive_Bayes"]), str(tmp_path / "model"))
    line = json.dumps({"text": "good day", "user": "u", "timestamp": "2024-01-01T00:00:00Z", "location": "x"})
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a").write_text("\n".join([line, line, line, "broken", '{"text":"x"}']) + "\n")
    place = {name: str(tmp_path / name) for name in ("raw", "dead", "documents", "topic", "cp", "model")}
    jobs.main(
        ["score", "--input", place["raw"], "--model", place["model"], "--documents", place["documents"], "--once"]
        + ["--dead", place["dead"], "--results", place["topic"], "--checkpoint", place["cp"], "--unique-for", "1 hour"]
    )
    assert sorted(values(spark.read.parquet(place["dead"]), "reason")) == ["malformed_json", "missing_user"]
    assert read_log(spark, place["documents"]).count() == spark.read.text(place["topic"]).count() == 1


def test_topics_of_a_cluster_need_no_folder():
    options = jobs._parser().parse_args(
        ["score", "--servers", "k:9092", "--input", "in", "--model", "m", "--documents", "d", "--checkpoint", "c", "--dead", "x"]
    )
    assert options.run is jobs.score and options.results is None and options.starting == "earliest"
    with pytest.raises(SystemExit):
        jobs._parser().parse_args(["score"])


def test_keyed_documents_index_and_search(spark, rows, tmp_path, capsys):
    comments = rows([("good", "positive"), ("bad", "negative")], "Comment string, Sentiment string")
    models.save_model(models.train(with_clean_text(comments, "Comment"), models.classifiers()["Naive_Bayes"]), str(tmp_path / "model"))
    place = {name: str(tmp_path / name) for name in ("raw", "dead", "documents", "cp", "model", "texts", "index")}
    for name, texts in (("a", ["good day", "bad day"]), ("b", ["good day", "good night"])):
        (tmp_path / "raw").mkdir(exist_ok=True)
        lines = [json.dumps({"text": t, "user": "u", "timestamp": "2024-01-01T00:00:00Z", "location": "x"}) for t in texts]
        (tmp_path / "raw" / name).write_text("\n".join(lines) + "\n")
        jobs.main(
            ["score", "--input", place["raw"], "--model", place["model"], "--documents", place["documents"], "--once", "--keyed"]
            + ["--dead", place["dead"], "--checkpoint", place["cp"], "--max-bytes", "1000000"]
        )
    held = KeyedTable(spark, place["documents"], dimensions=("source", "sentiment"))
    assert sorted(values(held.read(), "text")) == ["bad day", "good day", "good night"]
    assert sum(values(held.counts(), "n")) == 3
    held.read().write.parquet(place["texts"])
    jobs.main(["index", "--documents", place["texts"], "--index", place["index"], "--segment", "one"])
    capsys.readouterr()
    jobs.main(["search", "--index", place["index"], "--words", "good night"])
    best = next(row.id for row in held.read().collect() if row.text == "good night")
    assert best in capsys.readouterr().out.split("\n")[3]
