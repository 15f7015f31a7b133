import random

import pytest
from conftest import values

from chatterlens.operators.keyed_table import KeyedTable

SCHEMA = "id long, kind string, v int, arrival int"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"), buckets=8, dimensions=("kind",))


def batches(n, seed=1):
    rng = random.Random(seed)
    key = lambda: rng.choice([None, *range(40)])
    return [[(key(), rng.choice(["a", "b", None]), rng.randrange(100), i) for i in range(rng.randrange(1, 30))] for _ in range(n)]


def current(parts):
    held = {}
    for part in parts:
        held |= {row[0]: row for row in sorted(part, key=lambda row: row[3])}
    return held


def counted(held):
    kinds = [row[1] for row in held.values()]
    return sorted(((kind, kinds.count(kind)) for kind in set(kinds)), key=repr)


def test_documents_and_counts_follow_the_batches(rows, table):
    parts = batches(6)
    for number, part in enumerate(parts):
        assert table.upsert(rows(part, SCHEMA), number)
        held = current(parts[: number + 1])
        assert values(table.read()) == sorted(held.values(), key=repr)
        assert values(table.counts()) == counted(held)


def test_a_replayed_batch_changes_nothing_and_another_run_does(rows, table):
    first, second = [(1, "a", 1, 0)], [(1, "b", 2, 0)]
    table.upsert(rows(first, SCHEMA), 0, "x")
    table.upsert(rows(second, SCHEMA), 1, "x")
    assert not table.upsert(rows(first, SCHEMA), 0, "x")
    assert values(table.read()) == second
    assert table.upsert(rows(first, SCHEMA), 0, "y") and values(table.read()) == first and values(table.counts()) == [("a", 1)]


def test_a_crash_before_the_swap_leaves_the_old_table(rows, table, monkeypatch):
    table.upsert(rows([(1, "a", 1, 0), (2, "a", 1, 0)], SCHEMA), 0)
    before = values(table.read()), values(table.counts())

    def crash(self, manifest):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_swap", crash)
        with pytest.raises(RuntimeError):
            table.upsert(rows([(1, "b", 9, 0), (3, "b", 9, 0)], SCHEMA), 1)
    assert (values(table.read()), values(table.counts())) == before
    assert table.upsert(rows([(2, "c", 5, 0)], SCHEMA), 1)
    assert values(table.read()) == [(1, "a", 1, 0), (2, "c", 5, 0)] and values(table.counts()) == [("a", 1), ("c", 1)]


def test_reading_ranks_and_shuffles_nothing(rows, table):
    table.upsert(rows(batches(1)[0], SCHEMA), 0)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, rows, table):
    table.upsert(rows([(i, "a", 0, 0) for i in range(200)], SCHEMA), 0)
    before = table.manifest().buckets
    table.upsert(rows([(5, "b", 1, 0)], SCHEMA), 1)
    after = table.manifest().buckets
    assert len(before) == 8 and sum(after[bucket] != before[bucket] for bucket in before) == 1
    found = table.read_keys(rows([(5,), (7,), (999,)], "id long"))
    assert values(found) == [(5, "b", 1, 0), (7, "a", 0, 0)]
    read = {path.split("_bucket=")[1].split("/")[0] for path in found.inputFiles()}
    assert len(read) <= 3


def test_vacuum_keeps_what_the_last_versions_need(rows, table):
    parts = batches(5, seed=3)
    for number, part in enumerate(parts):
        table.upsert(rows(part, SCHEMA), number)
    table.vacuum(keep=1)
    held = current(parts)
    assert values(table.read()) == sorted(held.values(), key=repr) and values(table.counts()) == counted(held)
    assert table._names("manifest") == ["000000000005.json"] or ".000000000005.json.crc" in table._names("manifest")
    table.upsert(rows([(1, "z", 0, 0)], SCHEMA), 9)
    assert (1, "z", 0, 0) in values(table.read())


def test_count_folders_are_summed_up(rows, table, monkeypatch):
    monkeypatch.setattr("chatterlens.operators.keyed_table.MOST_COUNT_FOLDERS", 2)
    parts = batches(5, seed=4)
    for number, part in enumerate(parts):
        table.upsert(rows(part, SCHEMA), number)
        assert len(table.manifest().counts) <= 2 and values(table.counts()) == counted(current(parts[: number + 1]))


def test_an_empty_batch_and_a_new_table(rows, table):
    with pytest.raises(ValueError):
        table.read()
    table.upsert(rows([], SCHEMA), 0)
    assert table.read().count() == 0 and table.counts().count() == 0
    table.upsert(rows([(None, None, None, 1)], SCHEMA), 1)
    table.upsert(rows([(None, "a", 2, 1)], SCHEMA), 2)
    assert values(table.read()) == [(None, "a", 2, 1)] and values(table.counts()) == [("a", 1)]


def test_columns_named_like_parts_of_the_table(spark, rows, tmp_path):
    named = KeyedTable(spark, str(tmp_path / "t"), buckets=2, order=(), dimensions=("version",))
    for number in range(3):
        named.upsert(rows([(number % 2, 7 + number, 1)], "id long, version int, bucket int"), number)
    assert values(named.read()) == [(0, 9, 1), (1, 8, 1)] and values(named.counts()) == [(8, 1), (9, 1)]


def test_buckets_whose_rows_are_all_replaced_are_not_moved(spark, rows, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "few"), buckets=4)
    schema = "id string, text string"
    first = rows([(f"id-{number}", "old") for number in range(40)], schema)
    table.upsert(first, 0)
    bucket = {r.id: r["_bucket"] for r in first.select("id", table._bucket()).collect()}
    spared = min(bucket)
    seen, read = [], KeyedTable._rows
    monkeypatch.setattr(KeyedTable, "_rows", lambda self, manifest, buckets: seen.append(list(buckets)) or read(self, manifest, buckets))
    table.upsert(rows([(id, "new") for id in bucket if id != spared], schema), 1)
    assert seen == [[0, 1, 2, 3], [bucket[spared]]]
    assert {tuple(r) for r in table.read().collect()} == {(id, "old" if id == spared else "new") for id in bucket}
