import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from medallion.llm import queries, templates
from tests.conftest import plan
from verification.compare import connect, differences

SCHEMA = "doc_id long, text string, n_chars long, leaf int, h string"


def frame(spark, texts):
    return spark.createDataFrame([(d, t, len(t or ""), 1, "own") for d, t in texts], SCHEMA).repartition(3)


def run(spark, texts, **options):
    made = templates.drop_recurring_lines(frame(spark, texts), length_col="n_chars", **options)
    assert made.columns == ["doc_id", "text", "n_chars", "leaf", "h"]
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) or r.text is None for r in made.collect())
    return {r.doc_id: r.text for r in made.collect()}


def test_query_equals_sql_and_runs_no_python(spark):
    sf_dir = "/root/testdata/sf0.001"
    result = queries.op8_line_dedup(spark, sf_dir)
    with connect(sf_dir) as connection:
        assert differences(result, connection, templates.ORACLE) == ""
    assert "Python" not in plan(result) and "Arrow" not in plan(result)
    assert result.filter("n_dropped > 0").count() > 0


def test_the_first_document_keeps_a_recurring_line(spark):
    line = "All rights reserved by us"
    got = run(spark, [(3, f"a\n{line}\nb"), (1, f"{line}\nx y z\n{line}"), (2, f"  {line}\t\nc"), (4, "nothing here")])
    assert got == {1: f"{line}\nx y z\n{line}", 3: "a\nb", 2: "c", 4: "nothing here"}


def test_variable_fields_are_generalised(spark):
    names = ["Ann", "Bob", "Cid", "Dora"]
    texts = [(i, f"body {i} own text {i}\nPosted on 2024-01-0{i} by {n} in the forum") for i, n in enumerate(names)]
    got = run(spark, texts)
    assert got[0].endswith("by Ann in the forum")
    assert [got[i].count("\n") for i in (1, 2, 3)] == [0, 0, 0]


def test_lines_that_only_share_a_leaf_stay(spark):
    texts = [(i, f"In the year {' '.join(f'{w}{chr(97 + i)}' for w in ('kings', 'ships', 'seas', 'moons'))}") for i in range(6)]
    assert run(spark, texts) == dict(texts)


def test_two_documents_are_enough_for_equal_lines_only(spark):
    twenty = " ".join(f"w{chr(97 + i)}" for i in range(20))
    texts = [(1, f"{twenty}\na"), (2, f"{twenty}\nb"), (2, f"{twenty}\nb"), (3, "c x y z"), (3, "c x y z")]
    docs = frame(spark, texts)
    got = sorted((r.doc_id, r.text) for r in templates.drop_recurring_lines(docs).collect())
    assert got == [(1, f"{twenty}\na"), (2, "b"), (2, "b"), (3, "c x y z"), (3, "c x y z")]
    texts = [(1, "at 10 we met our friends"), (2, "at 11 we met our friends")]
    assert run(spark, texts) == dict(texts)


def test_many_lines_of_one_document_count_once(spark):
    """Twenty lines of one document do not make its value constant."""
    line = "our shop in {} is open every day"
    texts = [(0, "\n".join(line.format("Paris") for _ in range(20)))]
    texts += [(i, f"{i}\n{line.format(city)}") for i, city in enumerate(("Rome", "Oslo", "Paris"), 1)]
    got = run(spark, texts)
    assert got == {0: texts[0][1], 1: "1", 2: "2", 3: "3"}
    assert got == without(texts, brute_force(texts))


@pytest.mark.parametrize("place", [0, 1, 2])
def test_a_variable_leading_word_is_generalised(spark, place):
    names = ["Ann", "Bob", "Cid", "Dora", "Eve", "Finn", "Gus", "Hal"]
    words = ["Dear", "friend", "many", "thanks", "for", "all", "your", "help"]
    texts = []
    for i, name in enumerate(names):
        own = list(words)
        own[place] = name
        texts.append((i, f"{name}\n{' '.join(own)}"))
    got = run(spark, texts)
    assert got == {0: texts[0][1], **{i: names[i] for i in range(1, 8)}}
    assert got == without(texts, brute_force(texts))


@pytest.mark.parametrize("token", ["x" * 100_000, "1" * 100_000, ("x" * 50_000) + "1"])
def test_very_long_tokens(spark, token):
    texts = [(i, f"{i}\n{token} is a long token here") for i in range(3)]
    assert {len(t) for t in run(spark, texts).values()} <= {1, len(token) + 25 - 1, len(token) + 23}


def test_nulls_blank_lines_repeats_and_empty_tables(spark):
    line = "footer of every page here"
    texts = [(1, None), (2, ""), (3, "\n \n"), (None, f"{line}\n\nz"), (5, line), (6, f"\n{line}"), (7, f"{line}\n{line}")]
    got = run(spark, texts)
    assert got == {1: None, 2: "", 3: "\n \n", None: "\nz", 5: line, 6: "", 7: ""}
    docs = frame(spark, [(5, line), (8, line), (8, line), (9, f"a\n{line}")])
    kept = templates.drop_recurring_lines(docs, dropped_col="n")
    assert sorted((r.doc_id, r.text, r.n) for r in kept.collect()) == [(5, line, 0), (8, "", 1), (8, "", 1), (9, "a", 1)]
    assert templates.drop_recurring_lines(docs.filter(F.lit(False))).count() == 0


def brute_force(texts, depth=3, min_docs=3, min_constant=0.6, min_share=0.5, many=3, min_equal=2):
    """Which lines each document loses, by sets of documents."""
    lines = []
    for d, text in texts:
        for pos, line in enumerate(text.split("\n")):
            if line.split():
                tokens = tuple("<*>" if re.search("[0-9]", t) else t for t in line.split())
                lines.append((d, pos, " ".join(line.split()), tokens))
    takers, children = defaultdict(set), defaultdict(set)
    for d, _, _, tokens in lines:
        takers[len(tokens), tokens[:depth]].add(d)
    for size, lead in takers:
        for j, token in enumerate(lead):
            if token != "<*>":
                children[size, j, lead[:j] + lead[j + 1 :]].add((size, lead))
    reached = {node: sum(len(takers[p]) for p in paths) for node, paths in children.items() if len(paths) >= many}

    def leaf(tokens):
        size, lead = len(tokens), tokens[:depth]
        nodes = [(size, j, lead[:j] + lead[j + 1 :]) for j in range(len(lead)) if lead[j] != "<*>"]
        nodes = [n for n in nodes if n in reached] if len(takers[size, lead]) < min_docs else []
        return max(nodes, key=lambda n: (reached[n], -n[1])) if nodes else (size, None, lead)

    leaves, equal, lost = defaultdict(list), defaultdict(set), defaultdict(set)
    for d, pos, said, tokens in lines:
        leaves[leaf(tokens)].append((d, pos, tokens))
        equal[said].add(d)
    first = {}
    for (size, j, _), found in leaves.items():
        if len({d for d, _, _ in found}) < min_docs or len({t for _, _, t in found}) < 2:
            continue
        docs, places = defaultdict(set), defaultdict(list)
        for d, _, tokens in found:
            for at in enumerate(tokens):
                docs[at].add(d)
        for d, pos, tokens in found:
            counts = [0 if t == "<*>" or i == j else len(docs[i, t]) for i, t in enumerate(tokens)]
            least = sorted(counts, reverse=True)[math.ceil(min_constant * size) - 1]
            if least >= min_docs:
                bound = max(min_docs, min_share * least)
                places[tuple(t if n >= bound else None for t, n in zip(tokens, counts))].append((d, pos))
        for found in places.values():
            if len({d for d, _ in found}) >= min_docs:
                first |= dict.fromkeys(found, min(found)[0])
    for d, pos, said, _ in lines:
        keeper = first.get((d, pos), min(equal[said]) if len(equal[said]) >= min_equal else d)
        if keeper != d:
            lost[d].add(pos)
    return lost


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "c", "d", "e", "7"])
    frames = [[word() if rng.random() < 0.7 else None for _ in range(rng.choice([2, 3, 5, 8]))] for _ in range(8)]
    texts = []
    for d in range(60):
        own = [" ".join(w or word() for w in rng.choice(frames)) for _ in range(rng.randrange(1, 5))]
        own += [f"x{'uvw'[rng.randrange(3)]} " * rng.randrange(1, 3)] + own[: rng.randrange(2)]
        texts.append((d, "\n".join(rng.sample(own, len(own)))))
    lost = brute_force(texts)
    assert lost and run(spark, texts) == without(texts, lost)


def without(texts, lost):
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in lost.get(d, ())) for d, t in texts}


@pytest.mark.parametrize("size", [17, 48, 160])
def test_scattered_variable_words_of_a_long_line(spark, size):
    rng = random.Random(size)
    line = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(size)]
    texts = []
    for d in range(12):
        own = list(line)
        for i in range(4, size, 7 if size > 17 else 4):
            own[i] = "".join(rng.choices("abcdefgh", k=12))
        texts.append((d, f"{chr(97 + d) * 9}\n{' '.join(own)}"))
    lost = brute_force(texts)
    assert lost == {d: {1} for d in range(1, 12)}
    assert run(spark, texts) == without(texts, lost)


def test_repeats_within_a_document_make_no_token_constant(spark):
    """Two documents have the rare words, one of them in several rows and lines."""
    first, second = "we met up at kappa lambda", "we met up at omega sigma"
    texts = [(1, f"{first}\n{first}\n{first}"), (2, second), (3, "we met up at tango delta")]
    lost = brute_force(texts)
    assert lost == {2: {0}, 3: {0}}
    assert run(spark, texts) == without(texts, lost)


@pytest.mark.parametrize("size", [12, 120, 600])
def test_a_template_is_found_whatever_the_size(spark, size):
    """Values of a field pass any fixed number of documents, their combinations do not."""
    rng = random.Random(size)
    name, city = ([f"{kind}{chr(97 + i)}" for i in range(20)] for kind in ("name", "city"))
    # Of the same leaf: a rare line, equal in three documents, and prose.
    texts = [(d, "Thanks for the fish and so long as we have it all") for d in range(1000, 1003)]
    texts += [(2000 + i, f"Thanks for the {' '.join(rng.choices(name + city, k=9))}") for i in range(20)]
    for d in range(size):
        texts.append((d, f"Thanks for the report by {rng.choice(name)} about {rng.choice(city)} sent to us today"))
    lost = brute_force(texts)
    assert lost == {d: {0} for d in [*range(1, size), 1001, 1002]}
    assert run(spark, texts) == without(texts, lost)


def test_lines_that_differ_in_digits_only_recur(spark):
    """Nothing else falls into their leaf; a line more there changes nothing."""
    line = "Printed on page {} of this book"
    texts = [(i, f"{'abcd'[i]} own\n{line.format(i + 10)}") for i in range(4)]
    expected = {0: texts[0][1], 1: "b own", 2: "c own", 3: "d own"}
    assert run(spark, texts) == expected
    other = "Printed on page 7 with our best wishes"
    assert run(spark, [*texts, (4, other)]) == {**expected, 4: other}
    # Two documents are too few, and mostly variable lines are no template.
    for texts in ([(i, line.format(i)) for i in (1, 2)], [(i, f"at {i} {i} {i}1 go") for i in (1, 2, 3)]):
        assert run(spark, texts) == dict(texts)


def test_one_line_is_a_template_where_equality_needs_more_documents(spark):
    texts = [(i, f"{'abc'[i]}\nAll rights reserved by us") for i in range(3)]
    assert run(spark, texts, min_equal=9) == {0: texts[0][1], 1: "b", 2: "c"}


def test_lines_are_split_once_a_document_and_documents_never_broadcast(spark):
    texts = [(i, f"{'abc'[i]}\nAll rights reserved by us") for i in range(3)]
    made = templates.drop_recurring_lines(frame(spark, texts))
    made.collect()
    assert "element_at(split(" not in plan(made)
    assert "SortMergeJoin" in plan(made) and not re.search("BroadcastHashJoin .*LeftOuter", plan(made))


def test_the_second_reading_makes_nothing_but_masked_lines(spark):
    texts = [(1, " by  Ann on 2024-01-01\t\n\n \r\nno digits here"), (2, None), (3, "a1 b\x0bc")]
    read = templates.masked_lines(frame(spark, texts), "text")
    parsed = templates.parsed_lines(frame(spark, texts), "doc_id", "text", 3).select("mask", "text")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, parsed.collect())) and read.count() == 3
    assert "substring_index" not in plan(read)


def test_the_least_count_is_taken_once_a_line(spark):
    texts = spark.createDataFrame([(1, 1, -1, 3, "a b c d e f")], "leaf long, mask long, open int, of_leaf long, text string")
    places = texts.select("leaf", "mask", F.lit(3).cast("long").alias("n"))
    several = texts.select("leaf", "mask", F.lit(1).alias("doc_id"), F.lit(1).alias("h"))
    made = templates._templates(texts, places, several, 3, 3, 0.6)
    assert made.count() == 1
    assert not re.search(r"filter\(parts[^\n]*sort_array", plan(made))


def test_marks_tell_keys_of_one_word_apart(spark):
    """As many keys as marks have words would leave next to nothing out otherwise."""
    word = 12345
    keys = [word + (i << 58) for i in range(-32, 32)]
    df = spark.createDataFrame([(k,) for k in [*keys, word + 1, -1]], "key long")
    wanted = spark.createDataFrame([(k,) for k in [*keys[::2], keys[0]]], "key long")
    assert sorted(r.key for r in templates._marked(df, "key", wanted).collect()) == keys[::2]


def test_paths_of_one_line_move_without_their_documents(spark):
    """Documents are counted, of any number of lines and rows, but only moved for paths of several lines."""
    texts = [(1, "a b c\na b c\nd e f"), (1, "a b c\na b c\nd e f"), (2, "a b c"), (None, "a b c"), (3, "g h i")]
    rows = templates.parsed_lines(frame(spark, texts), "doc_id", "text", 3).drop("text")
    paths = templates._paths(rows, templates.Scratch(spark, "paths"))
    assert sorted(r.n for r in paths.collect()) == [1, 1, 3]
    assert "doc_id" not in plan(paths)
