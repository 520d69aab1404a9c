import zlib
from collections import defaultdict
from hashlib import sha256

from reckoner.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def lowered(row):
    return {**row, "text": None if row["text"] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])}


def climb(nodes):
    """What remains, and for each node its siblings level by level."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place // 8 * 8 : place // 8 * 8 + 8]
            steps[i].append(("".join(run[: place % 8]), "".join(run[place % 8 + 1 :])))
        nodes, at = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)], [p // 8 for p in at]
    return nodes[0], steps


def brute(rows):
    langs = defaultdict(list)
    for row in rows:
        langs[row["lang"]].append((row["doc_id"] is None, row["doc_id"] or 0, leaf(row), row))
    keys = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: climb([x[2] for x in langs[k].sort(key=lambda x: x[:3]) or langs[k]]) for k in keys}
    if not keys:
        return []
    root, above = climb([trees[k][0] for k in keys])
    out = []
    for k, upper in zip(keys, above, strict=True):
        for (_, _, own, row), steps in zip(langs[k], trees[k][1], strict=True):
            path = steps + upper
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
            fold = leaf(lowered(row)) if tampered else own
            for left, right in path:
                fold = sha(left + fold + right)
            out.append((row["doc_id"], own, trees[k][0], root, sha("".join(a + b for a, b in path)), fold, fold == root))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in merkle.verify(df).collect()), key=str)


def given(df):
    return [r.asDict() for r in df.select(*FIELDS).collect()]


def test_edges(edge):
    """Languages of one, few and many rows, a NULL one, NULL fields, NULL and repeated ids, clashing columns."""
    assert result(edge) == brute(given(edge))


def test_sizes_about_full_runs_and_blocks(spark):
    rows = [(i * 7, f"Text {i}", f"of {n}", None, i) for n in (1, 2, 8, 9, 64, 65, 512, 513, 600) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert result(docs) == brute(given(docs))


def test_rounds_above_a_block(spark, monkeypatch):
    """Blocks of eight: 700 rows take four rounds; a hot id and a hot row, 100 languages above."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(7 if i % 3 else i, "Same" if i % 2 else f"T{i}", "en", "s", 4) for i in range(700)]
    rows += [(1000 + i, "A", f"l{i}é", None, 1) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert result(docs) == brute(given(docs))


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "X", "en", None, 1), ("a", "Y", "en", None, 1)], "doc_id string, text string, lang string, source string, n_chars long")
    assert result(docs) == brute(given(docs))


def test_a_change_of_any_field_changes_the_root(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    base = (1, "ab", "en", "c", 2)
    roots = set()
    for row in [base, (2, *base[1:]), (1, "ab ", *base[2:]), (1, "a", "en", "bc", 2), (1, "ab", "en", None, 2), (1, "ab", "en", "c", None)]:
        roots.add(merkle.manifest(spark.createDataFrame([row], schema)).first()["root"])
    assert len(roots) == 6


def test_empty_table(empty):
    assert merkle.verify(empty).count() == 0
