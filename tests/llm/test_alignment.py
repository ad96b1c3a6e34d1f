"""Cross-tokenizer alignment against a version that compares every byte range."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from medallion.llm import alignment as L
from medallion.llm import queries, tokens

SCHEMA = "doc_id long, text string, key string, n_a int, copies int"


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(tokens.path(L.BYTE_FILE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokens.path(L.PIECE_FILE))
    byte_of = tokens.byte_of()

    def ranges(text):
        left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(f" {text}", add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            one = piece.startswith("<0x") and piece.endswith(">") and len(piece) == 6
            right.append((i, bytes([int(piece[3:5], 16)]) if one else piece.replace("▁", " ").encode()))
        made = []
        for side in (left, right):
            if b"".join(p for _, p in side) != f" {text}".encode():
                return None
            ends = np.cumsum([len(p) for _, p in side])
            made.append([(i, int(e) - len(p), int(e)) for (i, p), e in zip(side, ends, strict=True)])
        return made

    return ranges


def brute(docs, ranges):
    links, groups, counts = {}, {}, Counter()
    for k, (_, text) in enumerate(docs):
        found = ranges(text) if text else None
        if found is None:
            continue
        left, right = found
        links[k] = [(x[0], y[0]) for x in left for y in right if x[1] < y[2] and y[1] < x[2]]
        counts.update(links[k])
        cuts = sorted({x[2] for x in left} & {y[2] for y in right})
        parts, before = [], 0
        for cut in cuts:
            parts.append("|".join(",".join(str(t[0]) for t in s if before < t[2] <= cut) for s in (left, right)))
            before = cut
        groups[k] = len(left), len(right), len(cuts), hashlib.sha256(";".join(parts).encode()).hexdigest()
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for k, (doc, _) in enumerate(docs):
        n_a, n_b, n_groups, digest = groups.get(k, (0, 0, 0, ""))
        own = links.get(k, [])
        out.append(
            (doc, n_a, n_b, n_groups, len(own), sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own), digest)
        )
    return sorted(out, key=str), counts, best


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows(frame):
    return sorted([tuple(r) for r in frame.select(*COLUMNS).collect()], key=str)


@pytest.fixture
def invented():
    rng = random.Random(3)
    parts = ["the", "un", "believ", "able", " ", "  ", "\n", "\t", "é", "漢字", "😀", "'s", "12", "<|endoftext|>", "<s>", "</s>", "<0x41>", "á", "\x00", ".", "ж"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    docs += [(70 + i, docs[5][1]) for i in range(30)] + [(200, None), (201, ""), (202, "a ▁ b"), (203, " "), (None, "the end"), docs[9]]
    return docs + [(300, "word " * 400 + "ö"), (301, "x" * 3000)]


def test_equals_brute_force(spark, invented, both):
    want, counts, best = brute(invented, both)
    docs = spark.createDataFrame([(*d, "x", 1, 2) for d in invented], SCHEMA).repartition(5)
    made = L.Alignment(docs)
    assert rows(made.measures()) == want
    pairs = {(r.a_id, r.b_id): (r.n, r.best) for r in made.pair_counts().collect()}
    assert pairs == {p: (n, n == best[p[1]]) for p, n in counts.items()}
    assert rows(L.align_documents(docs, block_pairs=100)) == want


def test_query_equals_brute_force(spark, both):
    sf_dir = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    short = [d for d in docs if len(d[1] or "") < 2000]
    want, _, _ = brute(short, both)
    assert rows(L.align_documents(spark.createDataFrame(short, "doc_id long, text string"))) == want
    made = queries.op13_alignment(spark, sf_dir)
    assert {r.doc_id: r.groups_sha256 for r in made.collect()}.items() >= {w[0]: w[-1] for w in want}.items()
    assert made.count() == len(docs)


def test_small_slices_and_tasks_that_pass_pairs_on(spark, invented, both, monkeypatch):
    monkeypatch.setattr(L, "SLICE_BYTES", 100)
    monkeypatch.setattr(L, "SLICE_TOKENS", 50)
    monkeypatch.setattr(L, "COUNT_LINKS", 100)
    monkeypatch.setattr(L, "TASK_PAIRS", 150)
    left, right = L.byte_side(tokens.path(L.BYTE_FILE)), L.piece_side(tokens.path(L.PIECE_FILE))
    texts = [t for _, t in invented if t and both(t)]
    a = [np.array(x, left.packed) for x in left.encode(texts)]
    b = [np.array(x, right.packed) for x in right.encode(texts)]
    whole = L.Aligned(a, b, left, right)
    for i, text in enumerate(texts):
        one = L.Aligned(a[i : i + 1], b[i : i + 1], left, right)
        assert whole.groups()[i] == one.groups()[0]
        assert whole.per_text(whole.text_links + 1)[i] == len(one.link_a), text
    assert list(L._slices(np.array([60, 60, 10, 200, 1, 1]), 100)) == [(0, 1), (1, 3), (3, 4), (4, 6)]


def test_empty_table(spark):
    assert L.align_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    none = L.align_documents(spark.createDataFrame([(1, None, "", 1, 1)], SCHEMA)).collect()
    assert [tuple(r)[:5] for r in none] == [(1, 0, 0, 0, 0)]
