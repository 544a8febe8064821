"""Benchmark passages, licenses and neighbours against plain versions, with their edge cases."""

import random
import re

import numpy as np
import pytest

from skyledger.llm import contamination, licenses, neighbours

ITEM = "item_id string, text string, id long, n_words int"
DOC = "doc_id long, text string, items string, row int"
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def plain_passages(text, items, window=10):
    given, hit, found = words(text), set(), set()
    for name, item in items:
        own = words(item)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            run = own[k:k + window]
            for at in range(len(given) - len(run) + 1):
                if given[at:at + len(run)] == run:
                    hit |= set(range(at, at + len(run)))
                    found.add(name)
    return len(given), sorted(hit), sorted(found)


def passage_tables():
    rng = random.Random(4)
    pool = ["der", "see", "war", "still", "übung", "Ölfeld", "x1", "7", "tal", "日本"]
    items = [(f"q{i}", " ".join(rng.choices(pool, k=n)), i, n) for i, n in enumerate([3, 10, 11, 25, 1, 40, 0])]
    items += [("q1", items[3][1], 9, 0), ("null", None, 9, 0), ("marks", "?! ...", 9, 0), (None, items[1][1], 9, 0)]
    texts = [None, "", "...", "x1", items[1][1].upper(), "vor " + items[3][1].replace(" ", ", ") + "! nach", items[5][1] * 2]
    texts += [" ".join(rng.choices(pool, k=60)) for _ in range(6)] + ["w " * 50_000 + items[2][1]]
    docs = [(i, t, "a", 1) for i, t in enumerate(texts)] + [(4, texts[4], "b", 2), (4, "another text", "b", 2), (None, items[3][1], "c", 3)]
    return docs, items


@pytest.mark.parametrize("block_bytes", [contamination.BLOCK_BYTES, 60], ids=["one block", "many blocks"])
def test_passages_equal_plain_search(spark, block_bytes):
    docs, items = passage_tables()
    found = contamination.find_passages(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), block_bytes=block_bytes)
    rows = sorted(((str(r.id), r.n_words, list(r.hit_words), sorted(r["items"])) for r in found.collect()), key=str)
    named = [(str(name), text) for name, text, *_ in items]
    wanted = sorted(((str(i), *(list(x) if isinstance(x, list) else x for x in plain_passages(text, named))) for i, text, *_ in docs), key=str)
    assert rows == wanted


def test_spans_of_hits_are_the_words_in_the_text(spark):
    docs, items = passage_tables()
    texts = {i: t for i, t, *_ in docs[:14]}
    found = contamination.find_passages(spark.createDataFrame(docs[:14], DOC), spark.createDataFrame(items, ITEM), block_bytes=60)
    for r in found.collect():
        given = words(texts[r.id])
        data = (texts[r.id] or "").encode()
        assert [words(data[a:b].decode()) for a, b in zip(r.hit_starts, r.hit_ends)] == [[given[k]] for k in r.hit_words]


def test_passages_without_items_or_documents(spark):
    docs, items = passage_tables()
    none = contamination.find_passages(spark.createDataFrame(docs, DOC), spark.createDataFrame([], ITEM))
    rows = contamination.passage_digests(none).collect()
    assert len(rows) == len(docs) and not any(r.contaminated for r in rows)
    assert contamination.find_passages(spark.createDataFrame([], DOC), spark.createDataFrame(items, ITEM)).collect() == []


def plain_licenses(text, templates):
    """Names of the templates of which some window of any template's length holds enough shingles."""

    def cut(given):
        return [" ".join(given[k:k + licenses.SHINGLE]) for k in range(max(1, len(given) - licenses.SHINGLE + 1))] if given else []

    given = cut(re.findall("[a-z0-9]+", (text or "").lower()))
    known = {name: re.findall("[a-z0-9]+", t.lower()) for name, t in templates.items()}
    known = {name: (len(own), set(cut(own))) for name, own in known.items() if own}
    sizes = {max(1, n - licenses.SHINGLE + 1) for n, _ in known.values()}
    found = {}
    for at in range(len(given)):
        for size in sizes:
            window = set(given[at:at + size])
            for name, (_, own) in known.items():
                share = len(window & own) / len(own)
                if share >= licenses.CONTAINED:
                    found[name] = max(share, found.get(name, 0))
    return found


def notices():
    """Whole notices, notices with words lost at the start, inside and at the end, cut ones, and plain words."""

    rng = random.Random(6)
    filler = ["code", "may", "table", "one", "of", "the", "file", "license"]
    texts = [None, "", "license", " ".join(rng.choices(filler, k=300))]
    for name in sorted(licenses.TEMPLATES):
        given = licenses.TEMPLATES[name].split()
        around = lambda: " ".join(rng.choices(filler, k=rng.randrange(1, 40)))
        changed = list(given)
        changed[len(changed) // 2] = "other"
        for part in (given, given[2:], given[:-2], changed, given[len(given) // 2:]):
            texts.append(f"{around()} {' '.join(part).upper()} {around()}")
    texts.append("w " * 30_000 + licenses.TEMPLATES["MIT-header"])
    texts.append(" ".join(licenses.TEMPLATES.values()))
    return texts


def test_licenses_equal_plain_windows(spark):
    texts = notices()
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string, contained int")
    got = {}
    for r in licenses.find_licenses(docs).collect():
        got.setdefault(r.id, {})[r.license] = r.contained
    wanted = {i: plain_licenses(t, licenses.TEMPLATES) for i, t in enumerate(texts) if i != len(texts) - 2}
    wanted[len(texts) - 2] = {"MIT-header": 1.0}
    assert {i: set(f) for i, f in got.items()} == {i: set(f) for i, f in wanted.items() if f}
    for i, found in got.items():
        for name, share in found.items():
            assert share == pytest.approx(wanted[i][name])


def test_license_templates_may_be_many_repeated_or_empty(spark):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(400)]
    templates = {f"t{i}": " ".join(rng.choices(pool, k=12)) for i in range(600)}
    templates |= {"none": " .!", "again": templates["t7"]}
    docs = spark.createDataFrame([(1, f"so {templates['t7']} end"), (2, templates["t583"]), (2, templates["t583"]), (3, "w1 w2")],
                                 "doc_id long, text string")
    got = sorted((r.id, r.license, r.contained) for r in licenses.find_licenses(docs, templates=templates).collect())
    assert got == [(1, "again", 1.0), (1, "t7", 1.0), (2, "t583", 1.0), (2, "t583", 1.0)]
    assert licenses.find_licenses(docs, templates={}).collect() == []


def product(a, b):
    """The inner product, added up in order; sum() would compensate."""

    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def nearest_by_hand(rows, is_query, k):
    usable = {i: v for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = []
    for q in (i for i in usable if is_query(i)):
        near = sorted((-product(usable[q], v), i) for i, v in usable.items() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:k])]
    return sorted(out)


def test_neighbours_with_ties_doubles_and_large_numbers(spark):
    """Few vectors, so every part is read: order, ties to smaller ids, and scores in double precision of the vectors given."""

    rng = random.Random(9)
    rows = [(i, [rng.choice([-1.0, 0.1, 1 / 3, 1e60]) for _ in range(4)]) for i in range(50)]
    rows += [(100 + i, [0.1, 0.1, 1 / 3, 1 / 3]) for i in range(30)] + [(200, None), (220, [0.0] * 4), (240, [1.0, None, 0.0, 0.0]),
                                                                      (260, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    frame = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, rep int, id int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest(frame, lambda v: v % 20 == 0).collect())
    wanted = nearest_by_hand(rows, lambda i: i % 20 == 0, 20)
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    for g, w in zip(got, wanted):
        assert g[3] == pytest.approx(w[3], rel=1e-14)


def test_neighbours_of_no_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(frame, lambda v: v % 20 == 0).collect() == []
    assert neighbours.nearest(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>"), lambda v: v % 20 == 0).collect() == []
