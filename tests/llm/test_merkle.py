import hashlib
import random

import pytest

from medallion.llm import merkle


def random_text(rng, n):
    return "".join(rng.choice(["word ", "Ends. ", "x! ", "\n", "\n\n", " ", "é", "\t", "no.dot "]) for _ in range(n))


def leaves(node):
    return [leaf for child in node.children for leaf in leaves(child)] if node.children else [node]


def test_leaves_are_the_text():
    rng = random.Random(1)
    for n in [0, 1, 2, *range(3, 200, 7)]:
        text = random_text(rng, n)
        assert "".join(text[x.start : x.end] for x in leaves(merkle.tree(text))) == text


def test_fingerprints_show_the_tree():
    rng = random.Random(7)
    for n in [0, 1, 2, *range(3, 200, 7)]:
        text = random_text(rng, n)
        root = merkle.tree(text)
        shown = "/".join(",".join("".join(x.digest.hex()[: merkle.SHOWN] for x in p.children) for p in s.children) for s in root.children)
        assert merkle.fingerprint(text) == f"{root.digest.hex()}:{shown}"


def test_equal_fingerprints_mean_equal_texts():
    rng = random.Random(2)
    texts = {random_text(rng, rng.randrange(12)) for _ in range(500)} | {"a\nb", "a b", "a\n\nb", "a", "a\n", "", " "}
    assert len({merkle.fingerprint(t) for t in texts}) == len(texts)
    assert merkle.fingerprint(None) == merkle.fingerprint("")


def test_likeness():
    rng = random.Random(3)
    text = random_text(rng, 600)
    own = merkle.fingerprint(text)
    assert merkle.likeness(own, own) == 1
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1
    near = merkle.likeness(own, merkle.fingerprint(text[:900] + "changed " + text[900:]))
    other = merkle.likeness(own, merkle.fingerprint("something else. " * 90))
    assert 0.9 < near < 1 and other < 0.1
    swapped = merkle.likeness(merkle.fingerprint("a.\nb.\n"), merkle.fingerprint("b.\na.\n"))
    assert 0 <= swapped < 1


@pytest.mark.parametrize("text", [
    "one long sentence without any stop that goes on and on for quite some words until it ends at last here",
    "abcdefghijklmnopqrstuvwxyz" * 8, "\u6f22\u5b57\u4eee\u540d" * 30, "short words in a row here, ten or so of them",
])
def test_a_kept_half_shows_in_the_likeness(text):
    changed = merkle.edited(text, "0123456789 " * 100)
    assert 0.25 < merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(changed)) < 0.75


def test_few_documents_look_unlike_their_edits(spark):
    """An edit keeps half of every text, so hardly any may score as if nothing were left."""
    made = merkle.compare_with_edits(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    whole, low = made.filter("n_chars > 0").count(), made.filter("n_chars > 0 and near_edited < 0.25").count()
    assert low < 0.01 * whole


def test_differing_branches_locate_an_edit():
    rng = random.Random(4)
    text = random_text(rng, 800)
    at = 1500
    changed = text[:at] + "INSERTED" + text[at:]
    left, right = merkle.edits(text, changed)
    assert all(s <= at + 250 and e >= at - 250 for s, e in left + right)
    assert any(s <= at and e >= at + 8 for s, e in right)
    assert merkle.edits(text, text) == ([], [])
    assert merkle.edits(None, "abc") == ([], [(0, 3)])


@pytest.mark.parametrize("text", ["a" * 200_000, "a. " * 70_000, "." * 200_000, " " * 100_000, "a.b" * 70_000, "\n" * 50_000])
def test_odd_long_texts_take_linear_time(text):
    assert merkle.tree(text).end == len(text)


def plain(rows):
    """The contract over sorted rows."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    found = []
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = map(merkle.fingerprint, (text, edited, following))
        found.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, merkle.likeness(a, b), merkle.likeness(a, c)))
    return found


def by_text(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("buckets", [1, 4, 50])
def test_edits_with_the_next_document(spark, buckets):
    rng = random.Random(buckets)
    rows = [(i * 7 % 101, random_text(rng, rng.randrange(60))) for i in range(90)]
    rows += [(500, None), (501, ""), (-3, "last"), (7, "twin"), (7, "twin"), (None, "no id"), (None, "no id 2")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, bucket int, donor string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(buckets))
    try:
        got = [tuple(r) for r in merkle.compare_with_edits(docs).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert by_text(got) == by_text(plain(rows))


def test_one_row_and_no_row(spark):
    docs = spark.createDataFrame([(4, "one. two.")], "doc_id long, text string")
    assert by_text(tuple(r) for r in merkle.compare_with_edits(docs).collect()) == by_text(plain([(4, "one. two.")]))
    assert merkle.compare_with_edits(docs.limit(0)).count() == 0


def test_locate_edits_over_a_table(spark):
    pairs = spark.createDataFrame([(1, "a. b. c.", "a. X. c."), (2, None, None)], "i long, l string, r string")
    got = {r.i: r for r in merkle.locate_edits(pairs, "l", "r", ["i"]).collect()}
    assert [tuple(s) for s in got[1].left_spans] == [(3, 6)] and got[2].right_spans == []
    assert merkle.fingerprints(pairs, "i", "l").count() == 2
