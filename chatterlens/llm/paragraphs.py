"""Repeated passages: MinHash bands over paragraphs, exact Jaccard, and components of equal or similar ones.

A paragraph is a line of at least ``PARAGRAPH`` words; a line of more than ``LONG`` words is cut into several where its
words say. Equal paragraphs are one class. Classes that share a band and do not lie in one text alone are compared by
the exact Jaccard similarity of their shingles: each with the band's first class, all with each other in small bands,
and in large ones those that share a shingle of their prefixes and are not connected yet.

A repeated run of words may stand anywhere in a line. Beside the paragraphs there are therefore pieces of ``PARAGRAPH``
words that begin where the content says: at the smallest of any ``PASSAGE - PARAGRAPH + 1`` consecutive shingle hashes.
Two texts that share ``PASSAGE`` words in a row share at least one piece, wherever the run stands. The first and the
last words of a text are pieces too. Pieces are compared by equality.

Of every component of paragraphs, and of every class of pieces, the smallest document keeps its occurrences; in all
others they are cut. A similar paragraph is cut from the first to the last shingle that it shares with those it
resembles, a piece with the words to both sides that agree with those beside a kept one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.llm.bottom_k import PAIRED, candidates, central_pairs, outside_pairs, share_of, similar, text_key, with_component
from chatterlens.llm.hashing import BLANK_SEPARATED, Words, as_long, mixed, powers_up_to, slices, words_of
from chatterlens.llm.steps import connected_components, lasting, release, stored, temporary

SHINGLE = 5
PARAGRAPH = 24
PASSAGE = 50
REACH = PASSAGE - PARAGRAPH + 1
LONG = 200  # words of a line that stays whole
PART = 64  # shingles of which the least begins a part of a longer line
PERCENT = 80
ROWS = 2
RECALL = 0.95
BROADCAST_ROWS = 200_000  # rows of a few numbers
BROADCAST_KEYS = 1_000_000  # rows of one number
_LINE_BREAK = 10
_POSITION_BITS = np.uint64(28)
_SEEDS = mixed(np.arange(1, 65, dtype=np.uint64))
_WHOLE = np.uint64(0x5851F42D4C957F2D)


def bands_for(similarity: float, rows: int = ROWS, recall: float = RECALL) -> int:
    """Fewest bands that find a pair of that similarity with at least that chance."""
    bands, missed = 1, 1 - similarity**rows
    while 1 - missed**bands < recall:
        bands += 1
    return bands


def _least_places(hashes: np.ndarray, reach: int) -> np.ndarray:
    """Place of the smallest of each ``reach`` consecutive hashes; of equal upper bits the first."""
    low = (np.uint64(1) << _POSITION_BITS) - np.uint64(1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64) & low
    width = 1
    while width * 2 <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    return (least & low).astype(np.int64)


def anchors(words: Words, hashes: np.ndarray) -> np.ndarray:
    """First words of all pieces, in order of text and place; none in texts of fewer words than a piece."""
    first, end = words.first[:-1], words.first[1:]
    long_enough = end - first >= PARAGRAPH
    ends = np.concatenate([first[long_enough], end[long_enough] - PARAGRAPH])
    if len(hashes) < REACH:
        return np.unique(ends)
    least, text = _least_places(hashes, REACH), words.text_of_word()
    span = REACH + SHINGLE - 2
    chosen = least[text[: len(least)] == text[span : span + len(least)]]
    chosen = chosen[np.flatnonzero(np.diff(chosen, prepend=-1))]
    chosen = chosen[chosen + PARAGRAPH <= end[text[chosen]]]
    return np.unique(np.concatenate([ends, chosen]))


def paragraphs_of(words: Words, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of all paragraphs, in order."""
    n = len(words.starts)
    after_break = np.searchsorted(words.starts, np.flatnonzero(words.data == _LINE_BREAK))
    begins = np.unique(np.concatenate([words.first[:-1], after_break]))
    begins = begins[begins < n]
    ends = np.append(begins[1:], n)
    cuts = [begins]
    for begin, end in zip(begins[ends - begins > LONG].tolist(), ends[ends - begins > LONG].tolist()):
        at = begin
        for place in np.unique(begin + _least_places(shingles[begin : end - SHINGLE + 1], PART)).tolist():
            if place - at >= PARAGRAPH and end - place >= PARAGRAPH:
                cuts.append(np.array([place]))
                at = place
    begins = np.sort(np.concatenate(cuts)) if len(cuts) > 1 else begins
    ends = np.append(begins[1:], n)
    enough = ends - begins >= PARAGRAPH
    return begins[enough], ends[enough]


def _found(bands: int):
    """Arrow function: (id, row, text) to begin, end, class and band keys of all pieces and paragraphs.

    Pieces have no band keys; overlapping equal ones are one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = words_of(batch.column("text"), BLANK_SEPARATED)
            shingles, _ = words.windows(SHINGLE)
            whole, _ = words.windows(PARAGRAPH)
            text = words.text_of_word()
            at = anchors(words, shingles)
            at, last, _ = _runs(at, whole[at], text[at]) if len(at) else (at, at, at)
            yield _batch(batch, words, text, at, last + PARAGRAPH, whole[at], [None] * bands)
            begin, end = paragraphs_of(words, shingles)
            yield _batch(batch, words, text, begin, end, _whole_hashes(words, begin, end), band_keys(shingles, begin, end, bands))

    return run


def _batch(batch: pa.RecordBatch, words: Words, text: np.ndarray, begin: np.ndarray, end: np.ndarray, classes: np.ndarray, keys) -> pa.RecordBatch:
    row = text[begin] if len(begin) else begin
    columns = {name: batch.column(name).take(pa.array(row, pa.int64())) for name in ("id", "row")}
    columns |= {"begin": pa.array(begin - words.first[row], pa.int64()), "end": pa.array(end - words.first[row], pa.int64())}
    columns["class"] = pa.array(as_long(classes), pa.int64())
    for band, values in enumerate(keys):
        columns[f"band{band}"] = pa.nulls(len(begin), pa.int64()) if values is None else pa.array(as_long(values), pa.int64())
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _over(function: np.ufunc, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A function such as minimum over the values from each begin to its end, none of them empty."""
    if not len(begin):
        return np.zeros(0, values.dtype)
    return function.reduceat(np.append(values, values[:1]), np.column_stack([begin, end]).ravel())[::2]


def _whole_hashes(words: Words, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of all words of each paragraph, none that a piece has too."""
    up, down = powers_up_to(len(words.hashes))
    total = _over(np.add, words.hashes * up, begin, end) * down[begin]
    return mixed((total + (end - begin).astype(np.uint64)) ^ _WHOLE)


def _runs(at: np.ndarray, classes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, last place and text of each run of overlapping equal paragraphs, as in a word said a thousand times."""
    same = (classes[1:] == classes[:-1]) & (row[1:] == row[:-1]) & (np.diff(at) < PARAGRAPH)
    begins = np.flatnonzero(np.concatenate([[True], ~same]))
    return at[begins], at[np.concatenate([begins[1:], [len(at)]]) - 1], row[begins]


def band_keys(shingles: np.ndarray, begin: np.ndarray, end: np.ndarray, bands: int) -> Iterator[np.ndarray]:
    """Per band a hash of ``ROWS`` MinHash values of each paragraph."""
    for band in range(bands):
        key = np.full(len(begin), band, np.uint64)
        for seed in _SEEDS[band * ROWS : (band + 1) * ROWS]:
            key = mixed(key + _over(np.minimum, mixed(shingles ^ seed), begin, end - SHINGLE + 1))
        yield key


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (text, places) to (class, values, at): the distinct shingles of each paragraph in order of
    their first place, and these places within the paragraph."""
    for batch in slices(batches, "text"):
        words = words_of(batch.column("text"), BLANK_SEPARATED)
        shingles, _ = words.windows(SHINGLE)
        held = batch.column("places").flatten()
        text = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("places")).to_numpy())
        values, at = [], []
        for begin, end in zip(*(words.first[text] + held.field(name).to_numpy() for name in ("begin", "end"))):
            _, places = np.unique(shingles[begin : end - SHINGLE + 1], return_index=True)
            at.append(np.sort(places))
            values.append(as_long(shingles[begin + at[-1]]))
        columns = [held.field("class"), _lists(values, np.int64), _lists(at, np.int64)]
        yield pa.RecordBatch.from_arrays(columns, names=["class", "values", "at"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (text, ends) to the ends with hashes of the words beside them, outwards.

    ``REACH`` words are enough: where more agree, another piece of both texts begins.
    """
    for batch in slices(batches, "text"):
        words = words_of(batch.column("text"), BLANK_SEPARATED)
        hashes = (words.hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
        ends, held = batch.column("ends"), batch.column("ends").flatten()
        text = np.repeat(np.arange(batch.num_rows), pc.list_value_length(ends).to_numpy())
        columns = {field.name: held.field(i) for i, field in enumerate(held.type)}
        low, high = words.first[text], words.first[text + 1]
        at, left = low + columns["place"].to_numpy(), pc.equal(columns["side"], "left").to_numpy(zero_copy_only=False)
        before = zip(np.maximum(low, at - REACH), at, np.minimum(high, at + REACH), left)
        columns["words"] = _lists([hashes[a:b][::-1] if backwards else hashes[b:c] for a, b, c, backwards in before])
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _lists(arrays: list[np.ndarray], kind: type = np.int32) -> pa.Array:
    flat = np.concatenate(arrays) if arrays else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat.astype(kind)))


def _checked(rows: DataFrame) -> DataFrame:
    """Broadcast up to ``BROADCAST_ROWS`` rows of a few numbers, or ``BROADCAST_KEYS`` of one; more are shuffled."""
    most = BROADCAST_KEYS if len(rows.columns) == 1 else BROADCAST_ROWS
    return F.broadcast(rows) if rows.count() <= most else rows


def _checked_lists(rows: DataFrame, lists: str) -> DataFrame:
    """The same for rows with lists of a few numbers, by the entries of all lists."""
    entries = rows.agg(F.sum(F.size(lists))).first()[0] or 0
    return F.broadcast(rows) if entries <= BROADCAST_ROWS else rows


def _texts_with(docs: DataFrame, lists: DataFrame, name: str) -> DataFrame:
    """The documents of the lists (wanted_row, lists) with them. Texts of no list are left out before any shuffle."""
    wanted = _checked(stored(lists.select(F.col("wanted_row").alias("kept_row")), f"{name}-rows"))
    kept = docs.join(wanted, F.col("row") == F.col("kept_row"), "left_semi")
    return kept.join(_checked_lists(lists, name), F.col("row") == F.col("wanted_row"))


def row_key(key: str, text: str) -> Column:
    """One number for id and text; rows that repeat both are one document."""
    return F.xxhash64(F.col(f"`{key}`").try_cast("long"), text_key(text))


def band_groups(classes: DataFrame, bands: int) -> DataFrame:
    """(pivot, node) without repeats: all classes of the bands that have the same first class, but that one itself.

    Bands whose classes all lie in one text alone are left out: their pairs are no links.
    """
    band_of = F.explode(F.array(*[F.col(f"band{band}") for band in range(bands)]))
    entries = classes.where("band0 IS NOT NULL").select(F.col("class").alias("node"), "row", "last_row", band_of.alias("band"))
    ends = entries.groupBy("band").agg(
        F.min("row").alias("lowest"), F.max("last_row").alias("highest"), F.min("node").alias("pivot"), F.max("node").alias("other")
    )
    ends = _checked(stored(ends.where("lowest != highest AND pivot != other").select(F.col("band").alias("wanted"), "pivot"), "bands"))
    return entries.join(ends, F.col("band") == F.col("wanted")).where("node != pivot").select("pivot", "node").distinct()


def shingle_sets(docs: DataFrame, found: DataFrame, members: DataFrame) -> DataFrame:
    """(node, values, at, only) of the classes of groups: their shingles, and the text that alone has the class, else null."""
    wanted = members.select("node").union(members.select("pivot")).distinct().withColumnRenamed("node", "wanted")
    places = found.join(_checked(stored(wanted, "wanted-sets")), F.col("class") == F.col("wanted")).groupBy("class")
    only = F.when(F.min("row") == F.max("row"), F.min("row")).alias("only")
    places = stored(places.agg(F.min(F.struct("row", "begin", "end")).alias("first"), only), "first-places")
    by_row = places.groupBy(F.col("first.row").alias("wanted_row")).agg(
        F.collect_list(F.struct("class", "first.begin", "first.end")).alias("places")
    )
    texts = _texts_with(docs, stored(by_row, "places"), "places")
    sets = texts.select("text", "places").mapInArrow(_shingles, "class long, values array<long>, at array<long>")
    return sets.dropDuplicates(["class"]).join(places.select("class", "only"), "class").withColumnRenamed("class", "node")


def _with_sets(pairs: DataFrame, sets: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    one, two = (sets.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", *columns)]) for s in "ab")
    return pairs.join(two, F.col("b") == F.col("node_b")).join(one, F.col("a") == F.col("node_a"))


def similar_classes(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose shingles are similar enough, without those that one text alone has."""
    both = _with_sets(pairs, sets, ("values", "only"))
    both = both.where(~F.coalesce(F.col("only_a") == F.col("only_b"), F.lit(False)))
    shared = F.size(F.array_intersect("values_a", "values_b"))
    return both.where(similar(shared, F.size("values_a"), F.size("values_b"), percent)).select("a", "b")


def ranked_classes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, alone, prefix) of all members of large groups, as ``bottom_k.ranked_sets`` has them.

    Shingles that no other member has come first in every order, so only the others are joined with their counts.
    """
    everyone = members.select("node").union(members.select("pivot")).distinct()
    own = sets.join(everyone, "node", "left_semi").select("node", "values")
    entries = own.select("node", F.explode("values").alias("value"))
    spread = entries.groupBy("value").agg(F.count("*").alias("spread")).where("spread > 1")
    common = entries.join(spread, "value").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("spread", "value"))).alias("common"))
    ranked = own.select("node", F.size("values").cast("long").alias("n")).join(common, "node", "left")
    alone = (F.col("n") - F.coalesce(F.size("common"), F.lit(0))).alias("alone")
    first = F.transform(F.array_repeat(F.lit(1).cast("long"), alone.cast("int")), lambda one: F.struct(one.alias("spread"), F.lit(None).cast("long").alias("value")))
    order = F.concat(first, F.coalesce("common", F.array().cast("array<struct<spread: long, value: long>>")))
    prefix = F.slice(order, F.lit(1), (F.col("n") - share_of(F.col("n"), percent) + 1).cast("int"))
    return ranked.select("node", "n", alone, prefix.alias("prefix"))


def unsettled(members: DataFrame, components: DataFrame) -> DataFrame:
    """The members of those groups that lie in more than one component: in all others no link can change anything."""
    nodes = members.select("pivot", "node").union(members.select("pivot", F.col("pivot").alias("node")).distinct())
    held = with_component(nodes, components).groupBy("pivot").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return members.join(held.where("low != high").select("pivot"), "pivot", "left_semi")


def linked_classes(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) and (node, component) of the classes that are similar to another, as ``bottom_k.near_duplicates``
    finds them."""
    links = stored(similar_classes(candidates(members), sets, percent), "paragraph-links")
    components = connected_components(links)
    sizes = members.groupBy("pivot").agg(F.count("*").alias("size")).where(F.col("size") >= PAIRED)
    large = stored(unsettled(members.join(sizes, "pivot").select("pivot", "node"), components), "large-bands")
    if not large.isEmpty():
        ranked = stored(ranked_classes(large, sets, percent), "ranked-sets")
        for step in (central_pairs, lambda *group: outside_pairs(*group, percent)):
            more = step(large, with_component(ranked, components))
            more = more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            found = stored(similar_classes(more, sets, percent), "paragraph-links")
            links, components = links.union(found), connected_components(found, components)
    return links, components


def shared_spans(links: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, from, to) within each linked paragraph: the words from its first shingle that a linked one has to its last."""
    both = _with_sets(links.distinct(), sets, ("values", "at"))

    def span(own: str, other: str) -> list[Column]:
        shared = F.array_intersect(f"values_{own}", f"values_{other}")  # in the order of the first array
        place = lambda value: F.get(f"at_{own}", (F.array_position(f"values_{own}", value) - 1).cast("int"))
        last = place(F.element_at(shared, -1)) + SHINGLE
        return [F.col(own).alias("node"), place(F.element_at(shared, 1)).alias("from"), last.alias("to")]

    spans = both.select(*span("a", "b")).union(both.select(*span("b", "a")))
    return spans.groupBy("node").agg(F.min("from").alias("from"), F.max("to").alias("to"))


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, row, kept_id, begin, end) of every passage to cut: word positions, end exclusive.

    Words are parted by ASCII blanks, A-Z lower-cased; shingles have ``SHINGLE`` words. A passage is made of the
    paragraphs of one text that are equal or similar (``percent``) to such of the smallest document of their
    component, ``kept_id``, and of the runs of words that equal such of the smallest document that has them, if they
    hold a piece; a run of ``PASSAGE`` words always does. Overlapping passages, and those that fewer words than a
    shingle part, are one. Similar paragraphs that one text alone has are no link. Repeats within the document that
    keeps them stay. Lines and texts of fewer words than a paragraph have no passages.

    ``row`` is a hash of id and text; documents are ordered by id, a null id last, then by ``row``, and rows that
    repeat both are one document. Ids are whole numbers, or strings that spell them; other strings have no id. Null
    and empty texts have no passages. An empty table gives an empty result. Other columns are not read.
    """
    docs = docs.select(F.col(key).try_cast("long").alias("id"), row_key(key, text).alias("row"), F.col(text).alias("text"))
    with temporary(docs.sparkSession):
        named = _named(_held(docs, percent))
        around = _surrounded(docs, _ends(named.where("piece")))
        cut = _cut_paragraphs(named.where("NOT kept")).union(_extended(around))
        return lasting(_passages(cut), "passages")


def _held(docs: DataFrame, percent: int) -> DataFrame:
    """The occurrences of all pieces and paragraphs of several texts, with their component and what they share.

    Nothing else that is made on the way is kept.
    """
    bands = bands_for(percent / 100)
    with temporary(docs.sparkSession):
        names = [f"band{band}" for band in range(bands)]
        schema = ", ".join(f"{name} long" for name in ["id", "row", "begin", "end", "class", *names])
        found = stored(docs.mapInArrow(_found(bands), schema), "paragraphs")
        classes = found.groupBy("class").agg(
            F.min("row").alias("row"), F.max("row").alias("last_row"), *[F.first(name).alias(name) for name in names]
        )
        classes = stored(classes.where("row != last_row OR band0 IS NOT NULL"), "classes")
        release(docs.sparkSession)
        linked = _linked(docs, found, classes, bands, percent)
        wanted = classes.where("row != last_row").select("class").union(linked.select("linked")).distinct()
        wanted = _checked(stored(wanted.withColumnRenamed("class", "wanted"), "wanted"))
        held = found.join(wanted, F.col("class") == F.col("wanted"), "left_semi")
        held = held.join(_checked(linked), F.col("class") == F.col("linked"), "left").select(
            "id", "row", "begin", "end", "class", F.coalesce("component", "class").alias("component"), "from", "to", F.col("band0").isNull().alias("piece")
        )
        return lasting(held.distinct(), "held")


def _linked(docs: DataFrame, found: DataFrame, classes: DataFrame, bands: int, percent: int) -> DataFrame:
    """(linked, component, from, to) of the classes of paragraphs that are similar to another."""
    with temporary(docs.sparkSession):
        members = stored(band_groups(classes, bands), "band-groups")
        release(docs.sparkSession)
        sets = stored(shingle_sets(docs, found, members), "paragraph-sets")
        links, components = linked_classes(members, sets, percent)
        release(docs.sparkSession)
        linked = components.join(shared_spans(links, sets), "node").withColumnRenamed("node", "linked")
        return lasting(linked, "linked")


def _named(held: DataFrame) -> DataFrame:
    """The occurrences with kept_id, whether the component's first text has them (kept) and has their class (exact).

    Components that one text alone has are left out.
    """
    order = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("own")
    with temporary(held.sparkSession):
        classes = held.groupBy("component", "class").agg(order, F.min("row").alias("low"), F.max("row").alias("high"))
        classes = stored(classes, "held-classes")
        first = classes.groupBy("component").agg(F.min("own").alias("first"), F.min("low").alias("low"), F.max("high").alias("high"))
        first = first.where("low != high").select(F.col("component").alias("named"), "first")
        kept = classes.join(first, F.col("component") == F.col("named")).select(
            F.col("class").alias("named"), "first", (F.col("own.row") == F.col("first.row")).alias("exact")
        )
        named = held.join(_checked(stored(kept, "kept")), F.col("class") == F.col("named"))
        columns = [F.col("first.id").alias("kept_id"), "exact", (F.col("row") == F.col("first.row")).alias("kept")]
        return lasting(named.select(*held.columns, *columns), "named-paragraphs")


def _cut_paragraphs(named: DataFrame) -> DataFrame:
    """(id, row, kept_id, begin, end) of pieces and paragraphs: all of one that the keeping text has too, else what is
    shared."""
    part = ~F.col("exact") & F.col("from").isNotNull()
    begin, end = F.col("begin") + F.col("from"), F.col("begin") + F.col("to")
    return named.select(
        "id", "row", "kept_id", F.when(part, begin).otherwise(F.col("begin")).alias("begin"), F.when(part, end).otherwise(F.col("end")).alias("end")
    )


def _runs_of_spans(spans: DataFrame) -> DataFrame:
    """The spans (row, begin, end) with the number of the run that they are in: spans that overlap, or that fewer words
    than a shingle part."""
    by_place = Window.partitionBy("row").orderBy("begin", "end")
    before = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("apart", F.coalesce(F.col("begin") - before >= SHINGLE, F.lit(True)))
    return spans.withColumn("run", F.sum(F.col("apart").cast("int")).over(by_place)).drop("apart")


def _ends(named: DataFrame) -> DataFrame:
    """(id, row, kept_id, class, side, place, kept): where cut pieces may have to be extended, and where the kept pieces
    of their classes end.

    Only pieces within ``REACH`` of an end of their run of cut pieces can reach beyond it.
    """
    cut = _runs_of_spans(named.where("NOT kept").select("id", "row", "begin", "end", "class", "kept_id"))
    run = Window.partitionBy("row", "run")
    cut = cut.withColumns({"low": F.min("begin").over(run), "high": F.max("end").over(run)})
    side = lambda name, place: F.struct(F.lit(name).alias("side"), F.col(place).alias("place"))
    left = F.when(F.col("begin") - REACH < F.col("low"), side("left", "begin"))
    right = F.when(F.col("end") + REACH > F.col("high"), side("right", "end"))
    ends = cut.select("id", "row", "kept_id", "class", F.explode(F.array_compact(F.array(left, right))).alias("at"))
    ends = stored(ends.select("id", "row", "kept_id", "class", "at.side", "at.place", F.lit(False).alias("kept")), "cut-ends")
    both = F.explode(F.array(side("left", "begin"), side("right", "end"))).alias("at")
    kept = named.where("kept").select("id", "row", "kept_id", "class", both)
    kept = kept.select("id", "row", "kept_id", "class", "at.side", "at.place", F.lit(True).alias("kept"))
    return ends.union(kept.join(ends.select("class", "side").distinct(), ["class", "side"], "left_semi").select(ends.columns))


def _surrounded(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """The ends with the hashes of the words beside them."""
    by_row = ends.groupBy(F.col("row").alias("wanted_row")).agg(F.collect_list(F.struct(*ends.columns)).alias("ends"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ends.schema.fields)
    with temporary(docs.sparkSession):
        texts = _texts_with(docs, stored(by_row, "ends"), "ends")
        return lasting(texts.select("text", "ends").mapInArrow(_contexts, schema + ", words array<int>"), "surrounded-ends")


def _agreeing(one: Column, two: Column) -> Column:
    """Number of first entries that two arrays have in common; none with a null one."""
    parted = F.array_position(F.zip_with(one, two, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.coalesce(F.when(parted == 0, F.size(one)).otherwise(parted - 1), F.lit(0))


def agreements(contexts: DataFrame) -> DataFrame:
    """(class, side, words, agree) of contexts (class, side, words, kept): first words shared with a kept one at most.

    In the order of their words a context shares most with the kept ones next to it. Equal contexts are one row and
    contexts of different first words share nothing, so those that many texts have do not meet in one task.
    """
    each = contexts.where(F.size("words") > 0).groupBy("class", "side", "words").agg(F.max("kept").alias("held"))
    each = each.withColumn("kept_words", F.when(F.col("held"), F.col("words")))
    near = Window.partitionBy("class", "side", F.get("words", F.lit(0)))
    nearest = [F.last("kept_words", ignorenulls=True).over(near.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) for order in (F.asc("words"), F.desc("words"))]
    return each.select("class", "side", "words", F.greatest(*[_agreeing(F.col("words"), other) for other in nearest]).alias("agree"))


def _extended(around: DataFrame) -> DataFrame:
    """(id, row, kept_id, begin, end) of the words beside the cut pieces that agree with those beside a kept piece of the
    same class."""
    key = F.xxhash64("class", "side", "words").alias("context")
    agree = agreements(around.select("class", "side", "words", "kept")).where("agree > 0")
    agree = stored(agree.select(key, "agree"), "agreements")
    cut = around.where("NOT kept").select("id", "row", "kept_id", "side", "place", key).join(agree, "context")
    left, place = F.col("side") == "left", F.col("place")
    begin = F.when(left, place - F.col("agree")).otherwise(place)
    return cut.select("id", "row", "kept_id", begin.alias("begin"), F.when(left, place).otherwise(place + F.col("agree")).alias("end"))


def _passages(cut: DataFrame) -> DataFrame:
    """Join overlapping spans of a text, and those that a gap of less than a shingle parts."""
    cut = cut.groupBy("row", "begin").agg(F.max("end").alias("end"), F.first("id").alias("id"), F.min("kept_id").alias("kept_id"))
    ends = _runs_of_spans(cut).groupBy("row", "run").agg(
        F.first("id").alias("id"), F.min("kept_id").alias("kept_id"), F.min("begin").alias("begin"), F.max("end").alias("end")
    )
    return ends.select("id", "row", "kept_id", "begin", "end")


def cut_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Documents with their repeated passages cut; one that is left without words is dropped.

    A cut leaves a line break. All columns keep names and order; texts without a cut are unchanged, null texts
    included.
    """
    found = repeated_passages(docs, key, text, percent)
    spans = found.groupBy(F.col("row").alias("__row")).agg(F.array_sort(F.collect_list(F.array("begin", "end"))).alias("__spans"))
    spans = stored(spans, "spans")
    names = [f"`{name}`" for name in docs.columns]
    added = [T.StructField("__spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("__empty", T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *added])
    joined = docs.join(_checked_lists(spans, "__spans"), row_key(key, text) == F.col("__row"), "left").select(*names, "__spans")
    left = joined.mapInArrow(_cutter(text), schema)
    return left.where("NOT __empty").select(*names)


def _cutter(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            spans = batch.column("__spans")
            rows = np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False))
            empty = np.zeros(batch.num_rows, bool)
            columns = {name: batch.column(name) for name in batch.schema.names}
            if len(rows):
                values = columns[text].to_pylist()
                for row in rows:
                    values[row] = without_words(values[row], spans[int(row)].as_py())
                    empty[row] = not values[row].strip(" \t\n\v\f\r")
                columns[text] = pa.array(values, columns[text].type)
            columns["__empty"] = pa.array(empty)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def without_words(value: str, spans: list[list[int]]) -> str:
    words = words_of(pa.array([value]), BLANK_SEPARATED)
    raw, out, at = words.data.tobytes(), [], 0
    for begin, end in spans:
        out.append(raw[at : words.starts[begin]])
        at = words.ends[end - 1]
    return b"\n".join([*out, raw[at:]]).decode()
