import random
import re
from hashlib import sha256

from reckoner.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    lengths, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if (of := windows.get(tuple(w[i : i + k]))) is not None:
                    hit.update(range(i, i + k))
                    found |= of
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(map(str, out))


def result(docs, items):
    return sorted(str(tuple(r)) for r in decontaminate.digest(decontaminate.decontaminate(docs, items)).collect())


def test_random_texts_of_few_words(spark):
    """Frequent words, overlapping windows, short items, items that share texts and ids."""
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(["A", "b", "c1", "dé"]) for _ in range(n))
    items = [(i, text(rng.randrange(1, 16))) for i in range(12)] + [(3, "b b"), (20, "b b"), (21, None), (22, "?!"), (100, "c1")]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(80)]
    docs += [(200 + i, f"x {text(5)}, {rng.choice(items)[1]} {text(4)}") for i in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert result(d, spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items)


def test_items_with_text_ids(spark):
    """Ids need not be numbers; they sort as text, and one that is NULL names no item."""
    items = [("q-10", "a b c"), ("q-9", "b c"), ("é", "c"), ("10", "a b"), ("9", "a b"), (None, "z")]
    docs = spark.createDataFrame([(1, "a b c"), (2, "z")], "doc_id long, text string")
    found = decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id string, text string"))
    assert sorted((r.doc_id, r.n_hit, r["items"]) for r in found.collect()) == [(1, 3, ["10", "9", "q-10", "q-9", "é"]), (2, 1, [])]


def test_edges(spark, edge):
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    items = [(1, docs[0][1]), (2, "word5 and word6 and word7 and word8 and word9 and word10"), (3, "straße")]
    got = result(edge, spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, row_id int, n int"))
    assert got == brute(docs, items)


def test_a_passage_that_a_third_of_all_documents_share(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, f"{i} {passage} end{i}" if i % 3 == 0 else f"nothing of it {i}") for i in range(600)]
    items = [(7, passage)]
    assert result(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items)


def test_empty_tables(spark, edge, empty):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.decontaminate(empty, items).count() == 0
    none = decontaminate.decontaminate(edge, items.limit(0))
    assert none.count() == edge.count() and none.filter("n_hit > 0").count() == 0
