import random
import re
import zlib

import pytest

from lagscope.llm import toxicity

from .cases import ODD, no_documents, odd_documents, plain, rows_of

INSULTS = ["zorgon", "blifter", "quaxnar"]


def corpus(n=900):
    """Documents of which a third hold an insult, in words no other document has."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 60))
        toxic = i % 3 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(INSULTS) + rng.choice(["", "ly", "s"]))
        docs.append((i, " ".join(text), "s"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = corpus()
    frame = odd_documents(spark, docs + ODD)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    return docs, labels, frame, marks, toxicity.score_toxicity(frame, marks).collect()


def test_held_out_accuracy(scored):
    docs, labels, _, _, rows = scored
    toxic = dict((i, t) for i, _, t in labels)
    own = [r for r in rows if r.doc_id is not None and r.doc_id > 12]
    out = [r for r in own if r.held_out]
    assert 100 < len(out) and all(r.held_out == held(r.doc_id) for r in own)
    assert sum(r.predicted == toxic[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_one_row_per_document_also_for_odd_ones(scored):
    docs, _, _, _, rows = scored
    assert len(rows) == len(docs) + len(ODD)
    assert all(r.held_out is False for r in rows if r.doc_id is None)


def test_held_out_labels_are_not_learned(spark, scored):
    _, labels, frame, _, rows = scored
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    again = toxicity.score_toxicity(frame, spark.createDataFrame(turned, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, rows), key=repr)


def test_rejects_what_it_scores(scored):
    _, _, frame, marks, rows = scored
    kept = toxicity.reject_toxic(frame, marks)
    assert kept.columns == frame.columns
    clean = sorted((repr(r.doc_id) for r in rows if not r.predicted))
    assert sorted(repr(r.doc_id) for r in kept.collect()) == clean


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.score_toxicity(odd_documents(spark), empty).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.0}
    assert toxicity.score_toxicity(no_documents(spark), empty).count() == 0


def test_sample_is_bounded(spark):
    marks = spark.range(500).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 2 AS INT) AS toxic")
    rows = toxicity.training_rows(marks, 100)
    again = plain(toxicity.training_rows(marks.repartition(3), 100))
    assert rows.count() == 100 and rows_of(plain(rows), ["doc_id"]) == rows_of(again, ["doc_id"])


def test_a_labelled_id_on_many_rows_is_learned_once(spark):
    docs, labels = corpus(200)
    many = docs + [(0, f"{docs[0][1]} {i}", "s") for i in range(300)]
    frame = odd_documents(spark, many)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model, features = toxicity.fit(frame, marks, 150)
    assert features.count() == len(many)
    rows = toxicity.training_rows(marks, 150)
    seen = toxicity.learn_lexicon(frame, rows)
    again = toxicity.learn_lexicon(odd_documents(spark, many[::-1]), rows)
    assert seen == again == model.entries


def plain_features(text, entries):
    """Word by word and character by character."""
    text = text or ""
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())

    def odds(word):
        if len(word) > 40:
            return max((entries.get(word[:n] + "*", 0.0) for n in (4, 5, 6, 7)), default=0.0)
        stems = [entries.get(word[:n] + "*", 0.0) for n in (4, 5, 6, 7) if len(word) > n]
        return max([entries.get(word, 0.0), *stems])

    hits = [i for i, w in enumerate(found) if odds(w)]
    strong = [i for i in hits if odds(found[i]) >= 5]
    different = {found[i]: odds(found[i]) for i in hits}
    near = [i for i in hits if any(w in toxicity.SECOND_PERSONS for w in found[max(0, i - 5) : i + 6])]
    octets = text.encode()
    letter = lambda b: b >= 128 or chr(b).isalpha()
    mark = lambda b: b < 128 and not chr(b).isalpha() and b not in b" \t\n\v\f\r"
    inside = sum(letter(a) and mark(b) and letter(c) for a, b, c in zip(octets, octets[1:], octets[2:], strict=False))
    n, chars = max(1, len(found)), max(1, len(octets))
    return (
        len(strong), len(strong) / n, len(hits) - len(strong), (len(hits) - len(strong)) / n,
        max(different.values(), default=0), min(50, sum(different.values())), len(different),
        len(near) / max(1, len(hits)), sum(65 <= b <= 90 for b in octets) / chars,
        sum(map(mark, octets)) / chars, inside / n, len(found),
    )


def test_features_like_plain_python(spark):
    entries = {"zorgon": 6.0, "zorg*": 4.0, "blif*": 5.5, "Ünï*": 3.5, "w1": 3.0, "ünïc*": 3.2}
    texts = ["You zorgon! z0rg.on a-b c d", "BLIFTER blif w1 w1 far away from you", "x" * 50 + " zorg" + "y" * 50, "é.é 1a2"]
    rows = [(100 + i, t, "s") for i, t in enumerate(texts)] + ODD
    model = toxicity.ToxicityModel(entries, None, None)
    got = model.features(odd_documents(spark, rows)).select("doc_id", *toxicity.FEATURES).collect()
    want = sorted(((i, *plain_features(t, entries)) for i, t, _ in rows), key=repr)
    got = sorted((tuple(r) for r in got), key=lambda r: repr((r[0], *r[1:])))
    by_id = lambda rows: sorted(([r[0] is None, r[0] or 0, *map(float, r[1:])] for r in rows))
    for a, b in zip(by_id(got), by_id(want), strict=True):
        assert a == pytest.approx(b)
