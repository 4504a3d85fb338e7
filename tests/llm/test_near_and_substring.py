import itertools
import random
from collections import Counter

import pytest
from lamina.llm import lsh_forest, substring
from lamina.llm.common import WordHashes, jaccard_counts
from lamina.llm.lsh_forest import Forest, _Tree, near_duplicates, text_set

from .conftest import prose, words
from .test_links import union_find


def near_corpus(rng):
    texts = [prose(rng, rng.randint(30, 120)) for _ in range(30)]
    for i in range(0, 30, 3):  # copies with a few changed words, more and more of them
        for edits in range(1, 5):
            w = texts[i].split(" ")
            for _ in range(edits):
                w[rng.randrange(len(w))] = f"new{rng.randrange(999)}"
            texts.append(" ".join(w))
    texts += [texts[4]] * 3 + [texts[5].upper()]
    hub = prose(rng, 200).split(" ")
    for _ in range(60):  # a dense group
        w = list(hub)
        w[rng.randrange(200)] = "edit"
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("k,num", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(make_docs, k, num):
    texts = near_corpus(random.Random(k))
    docs = make_docs(texts)
    hashes = WordHashes()
    sets = [text_set(t, hashes, k) for t in texts]
    links = []
    for a, b in itertools.combinations(range(len(texts)), 2):
        both, either = jaccard_counts(sets[a], sets[b])
        if 100 * both >= num * either:
            links.append((a, b))
    want = {i: i for i in range(len(texts))} | union_find(links)
    got = {r["doc_id"]: r for r in near_duplicates(docs, Forest(shingle=k, num=num)).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i]) and r["n_shingles"] == len(sets[i]) for i, r in got.items())
    one = lsh_forest.keep_one(docs, Forest(shingle=k, num=num))
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(want.values())) and one.columns == docs.columns


def test_tree_pairs_do_not_depend_on_batches():
    forest = Forest(depth=3, min_depth=1, small=4, near=2)
    rng = random.Random(1)
    rows = sorted({(rng.randrange(3), bytes([rng.randrange(3), rng.randrange(2), 0]), rng.randrange(10**6)) for _ in range(150)})
    whole = _Tree(forest)
    want = set(whole.add(*map(list, zip(*rows)))) | set(whole.close())
    for size in (1, 2, 3, 7, 40):
        tree, got = _Tree(forest), set()
        for at in range(0, len(rows), size):
            got |= set(tree.add(*map(list, zip(*rows[at : at + size]))))
        assert got | set(tree.close()) == want


def test_near_duplicates_edges(edge_docs, no_docs):
    got = near_duplicates(edge_docs, Forest()).collect()
    assert len(got) == edge_docs.count()
    empty = [r for r in got if r["n_shingles"] == 0]
    assert len(empty) == 3 and all(r["kept"] and r["component_id"] == r["doc_id"] for r in empty)
    assert [r["component_id"] for r in got if r["doc_id"] in (5, 6)] == [5, 5]
    assert next(r for r in got if r["doc_id"] is None)["kept"]
    assert near_duplicates(no_docs, Forest()).count() == 0


def templated(rng, families, length, changes=1, end=""):
    """Two variants per family of one text: alike within a family, below a link across families."""
    base, out = [f"word{rng.randrange(9999)}" for _ in range(length)], []
    for n in range(families):
        own = list(base)
        for i in range(changes):
            own[rng.randrange(5, length - 5)] = f"family{n}_{i}"
        for side in "ab":
            w = list(own)
            w[rng.choice([i for i in range(5, length - 5) if w[i] == base[i]])] = f"{side}{n}"
            out.append(" ".join(w) + end)
    return out


def brute_components(sets, num):
    links = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
             for both, either in [jaccard_counts(sets[a], sets[b])] if 100 * both >= num * either]
    return {i: i for i in range(len(sets))} | union_find(links)


@pytest.mark.parametrize("branches", [2, 3, 6])
def test_pairs_that_share_a_region_are_given_or_noted(branches):
    forest = Forest()
    rng = random.Random(branches)
    rows = sorted((0, bytes([7] * 3 + [rng.randrange(branches) for _ in range(5)]), n) for n in range(300))
    tree, out = _Tree(forest), []
    for at in range(0, len(rows), 70):
        out += tree.add(*map(list, zip(*rows[at : at + 70])))
    out += tree.close()
    given, noted = {(a, b) for a, b, region in out if region is None}, {}
    for node, _, region in out:
        if region is not None:
            noted.setdefault(node, set()).add(region)
    for (_, k, x), (_, l, y) in itertools.combinations(rows, 2):
        if k[: forest.min_depth] == l[: forest.min_depth]:
            assert (min(x, y), max(x, y)) in given or noted.get(x, set()) & noted.get(y, set())


# --- substring ------------------------------------------------------------

def test_variants_of_one_paragraph_are_joined_as_by_brute_force(make_docs):
    texts = templated(random.Random(2), 60, 150, changes=2, end=".")
    hashes = WordHashes()
    want = brute_components([text_set(t, hashes, 5) for t in texts], 80)
    rows = substring.repeated_passages(make_docs(texts)).filter("n_words = 150").collect()  # natural paragraphs
    sizes = Counter(want.values())
    assert len(sizes) > 30
    assert {r["doc_id"]: r["keeper_doc_id"] for r in rows} == {i: c for i, c in want.items() if sizes[c] > 1}

def test_planted_passages_are_found_and_clean_documents_left(make_docs):
    rng = random.Random(9)
    passages = [prose(rng, rng.randint(60, 90)) for _ in range(8)]
    common = "A short line that stands in very many documents of this corpus."
    texts, planted = [], set()
    for n in range(120):
        text = prose(rng, rng.randint(80, 200)).split(" ")
        if n % 5 == 0:
            at = rng.randrange(len(text))  # in the middle of a line
            text[at:at] = [passages[n // 5 % 8]]
            planted.add(n)
        texts.append(" ".join(text) + ("\n" + common if n % 2 else ""))
    docs = make_docs(texts)
    found = substring.repeated_passages(docs)
    rows = found.collect()
    assert {r["doc_id"] for r in rows} == planted
    assert {r["doc_id"] for r in rows if r["removed"]} == {n for n in planted if n // 5 >= 8}  # the first stay
    left = {r["doc_id"]: r["text"] for r in substring.remove_passages(docs, found, count_col="n_chars").collect()}
    assert all(left[n] == t for n, t in enumerate(texts) if n not in planted or n // 5 < 8)
    assert all(len(left[n]) < len(texts[n]) - 100 for n in planted if n // 5 >= 8)


@pytest.mark.parametrize("length", [5, 12])
def test_hard_wrapped_passages_are_found(make_docs, length):
    """60 words in lines of ``length`` words, between lines that do not repeat."""
    rng = random.Random(length)
    lines = ["\n".join(" ".join(words(rng, length, "p")) for _ in range(60 // length)) for _ in range(4)]
    own = lambda: "\n".join(" ".join(words(rng, length)) for _ in range(12))
    texts = [own() + "\n" + lines[n % 4] + "\n" + own() for n in range(12)] + [own() for _ in range(12)]
    docs = make_docs(texts)
    found = substring.repeated_passages(docs)
    rows = found.collect()
    assert {r["doc_id"] for r in rows} == set(range(12))
    assert {r["doc_id"] for r in rows if r["removed"]} == set(range(4, 12))
    left = {r["doc_id"]: r["text"] for r in substring.remove_passages(docs, found).collect()}
    for n, text in enumerate(texts):
        cut = len(text.split()) - len(left[n].split())
        # up to 20 words at either end may stand before the first cut and after the last
        assert (20 <= cut <= 60 if 4 <= n < 12 else cut == 0), (n, cut)


def test_a_repeated_short_line_keeps_its_first_paragraph(make_docs):
    docs = make_docs(["\n".join(["ha ha."] * 20), "an other text of eight or more words here"])
    left = {r["doc_id"]: r["text"] for r in substring.remove_passages(docs, substring.repeated_passages(docs)).collect()}
    assert len(left[0].split()) >= 4 and left[1].startswith("an other")


@pytest.mark.parametrize("sentences", [0, 2, 4, 10])
def test_passages_of_51_words_inside_lines(make_docs, sentences):
    """All of them, wherever they stand, with few sentence ends or none."""
    rng = random.Random(sentences)
    texts, planted = [], set()
    for pair in range(60):
        passage = words(rng, 51, "p")
        for at in range(51 // sentences if sentences else 99, 51, 51 // sentences if sentences else 99):
            passage[at - 1] += "."
        for n in (2 * pair, 2 * pair + 1):
            own = words(rng, rng.randint(30, 90))
            at = rng.randrange(len(own))
            texts.append(" ".join(own[:at] + passage + own[at:]))
            planted.add(n)
    texts += [" ".join(words(rng, 100)) for _ in range(60)]
    rows = substring.repeated_passages(make_docs(texts)).collect()
    assert {r["doc_id"] for r in rows} == planted
    assert {r["doc_id"] for r in rows if r["removed"]} == {n for n in planted if n % 2}


def test_lines_that_do_not_repeat_together_are_no_passage(make_docs):
    rng = random.Random(1)
    one, other, foreign = (" ".join(words(rng, n, s)) for n, s in ((8, "a"), (8, "b"), (10, "c")))
    fill = lambda: " ".join(words(rng, 40))
    docs = make_docs(["\n".join([fill(), one, foreign, other, fill()]), fill() + "\n" + one + "\n" + fill(), fill() + "\n" + other])
    assert substring.repeated_passages(docs).collect() == []


def test_every_repeated_window_of_51_words_is_found(make_docs):
    """Brute force: all documents that share 51 words in a row with another."""
    rng = random.Random(6)
    texts = [words(rng, rng.randint(20, 400)) for _ in range(60)]
    for _ in range(40):
        a, b = rng.randrange(60), rng.randrange(60)
        n, at = rng.randint(20, 90), rng.randrange(len(texts[a]))
        to = rng.randrange(len(texts[b]))
        texts[b] = texts[b][:to] + texts[a][at : at + n] + texts[b][to:]
    holders = {}
    for n, w in enumerate(texts):
        for i in range(len(w) - 50):
            holders.setdefault(tuple(w[i : i + 51]), set()).add((n, i))
    want = {n for places in holders.values() if len({n for n, _ in places}) > 1 for n, _ in places}
    seams = [" ", "\n"]
    docs = make_docs(["".join(x + seams[i % 17 == 16] for i, x in enumerate(w)).strip() for w in texts])
    found = substring.repeated_passages(docs)
    rows = found.collect()
    assert len(want) > 5 and want <= {r["doc_id"] for r in rows}
    for r in rows:  # what was found stands somewhere else too
        run = texts[r["doc_id"]][r["start_word"] : r["start_word"] + min(r["n_words"], 19)]
        assert sum(run == w[i : i + len(run)] for w in texts for i in range(len(w))) > 1
    left = {r["doc_id"]: r["text"].split() for r in substring.remove_passages(docs, found).collect()}
    kept = {x for w in left.values() for x in w}
    assert {x for w in texts for x in w} == kept  # every word still stands somewhere


def test_near_equal_paragraphs_are_joined(make_docs):
    rng = random.Random(2)
    line = " ".join(f"word{rng.randrange(9999)}" for _ in range(80)) + "."  # one paragraph without inner cuts
    other = line.split(" ")
    other[40] = "changed"
    docs = make_docs([line, " ".join(other), prose(rng, 80)])
    rows = substring.repeated_passages(docs).collect()
    assert {(r["doc_id"], r["removed"], r["keeper_doc_id"]) for r in rows} == {(0, False, 0), (1, True, 0)}


def test_remove_whole_copies_and_edges(make_docs, edge_docs, no_docs):
    rng = random.Random(4)
    text = prose(rng, 100)
    docs = make_docs([(0, text), (1, text), (2, None), (3, ""), (4, "short"), (1, "an id that repeats")])
    left = substring.remove_passages(docs, substring.repeated_passages(docs)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left if r["text"] is not None) == [
        (0, text), (1, "an id that repeats"), (3, ""), (4, "short")] and len(left) == 5
    rows = substring.repeated_passages(edge_docs)
    assert rows.columns[0] == "doc_id" and rows.filter("doc_id in (0, 1, 2)").count() == 0
    assert substring.remove_passages(edge_docs, rows).columns == edge_docs.columns
    assert substring.repeated_passages(no_docs).count() == 0


def test_cut_words():
    assert substring.cut_words("a b\nc d e", [(1, 2)]) == "a d e"
    assert substring.cut_words("a b c", [(0, 1), (2, 1)]) == "b "
    assert substring.cut_words("a b\nc", [(2, 1)]) == "a b"
