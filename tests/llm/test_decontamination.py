import itertools
import random
import re

import pytest

from folio.llm import common
from folio.llm import decontamination as d


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items):
    """All alignments of all documents and items."""
    out = {}
    for doc_id, text in docs:
        a = words(text)
        for item_id, other in items:
            b = words(other)
            for shift in range(-len(b), len(a)):
                same = [0 <= shift + k < len(a) and a[shift + k] == b[k] for k in range(len(b))]
                best = (0, 0, 0, 0)
                for i in range(len(b)):
                    score = n = 0
                    for j in range(i, len(b)):
                        score += 1 if same[j] else -d.PENALTY
                        n += same[j]
                        best = max(best, (score, -j, i, n))
                length = 1 - best[1] - best[2]
                if len(b) >= d.LEAST_ITEM and length >= min(d.MIN_WORDS, len(b)) and best[3] >= d.MIN_SIMILARITY * length:
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), best[3])
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(12, 30)))) for i in range(20)] + [(90, ""), (91, None), (92, "too short")]
    items.append((50, items[4][1].upper()))
    docs = []
    for k in range(60):
        body = rng.choices(vocab, k=rng.randint(0, 60))
        if k % 3 == 0:
            passage = words(items[k % 20][1])
            for at in range(5, len(passage), 9):  # substitutions
                passage[at] = "zzz"
            at = rng.randint(0, len(body))
            body[at:at] = passage
        docs.append((k, ", ".join(body)))
    docs += [(100, None), (101, ""), (102, "!!!")]
    got = d.overlaps(spark.createDataFrame([(*r, 5, "x") for r in docs], "doc_id long, text string, item_id int, item string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, [i for i in items if i[0] != 50])
    assert {(r.doc_id, r.item_id) for r in got} == set(want)
    assert {r.doc_id for r in got} == {k for k in range(60) if k % 3 == 0}
    assert all(r.matched == want[r.doc_id, r.item_id] and r.similarity >= d.MIN_SIMILARITY for r in got)


def test_masks_hit_every_run_that_counts():
    """All ways in which the words of a run can differ: some mask meets only equal words somewhere."""
    for masks, lengths in ((d.LONG_MASKS, range(d.MIN_WORDS, 2 * d.MIN_WORDS)), (d.SHORT_MASKS, range(d.LEAST_ITEM, d.MIN_WORDS))):
        assert any(m != tuple(range(len(m))) for m in masks)
        for n in lengths:
            for wrong in itertools.combinations(range(n), int(n - d.MIN_SIMILARITY * n)):
                assert any(not any(i + o in wrong for o in m) for m in masks for i in range(n - m[-1])), (n, wrong)


def test_starts_repeats_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(d, "TOGETHER", 5)
    passage = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, '"' + passage), (2, passage), (2, passage), (3, "same " * 3000), (None, passage), (4, "x " * 200_000 + passage)]
    got = d.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, passage), (2, "same " * 20), (3, "seven eight nine"), (4, "a b"), (1, None)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.start for r in got if r.item_id != 2} == {(1, 1): 0, (1, 3): 6, (2, 1): 0, (2, 3): 6, (4, 1): 200_000, (4, 3): 200_006}
    assert [(r.doc_id, r.words, r.matched) for r in got if r.item_id == 2] == [(3, 20, 20)] and len(got) == 7


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    assert d.overlaps(docs.limit(0), items).collect() == []
    assert d.overlaps(docs, items.limit(0)).collect() == []
    assert [r.doc_id for r in d.without_leaks(docs, items).collect()] == [1]


def plain(docs, items):
    """Pairs with a run of enough words, at any alignment, that reaches MIN_SIMILARITY."""
    out = set()
    for doc_id, a in docs:
        for item_id, b in items:
            least = min(d.MIN_WORDS, len(b))
            if not set(a) & set(b):
                continue
            for shift in range(-len(b), len(a)):
                at = [0]
                for k in range(len(b)):
                    at.append(at[-1] + (0 <= shift + k < len(a) and a[shift + k] == b[k]))
                if any(at[j] - at[i] >= d.MIN_SIMILARITY * (j - i) for i in range(len(b)) for j in range(i + least, len(b) + 1)):
                    out.add((doc_id, item_id))
                    break
    return out


def test_recall_of_edited_copies(spark):
    rng = random.Random(8)
    fresh = iter(range(10**6))

    def other():
        return f"x{next(fresh)}"

    items, docs, sure = [], [], set()

    def case(n, edit, must):
        item = [f"i{len(items)}w{k}" for k in range(n)]
        items.append((len(items), item))
        docs.append((len(docs), [other() for _ in range(rng.randint(0, 9))] + edit(list(item)) + [other() for _ in range(rng.randint(0, 9))]))
        if must:
            sure.add((len(docs) - 1, len(items) - 1))

    def put(item, places):
        return [other() if k in places else w for k, w in enumerate(item)]

    for n in (16, 30, 60):
        for every in (3, 4, 5, 8):
            for first in range(every):
                case(n, lambda x: put(x, range(first, n, every)), every > 3 and first == every - 1)
    case(100, lambda x: put(x, [k for k in range(12, 100) if (k - 12) % 10 in (2, 5, 8)]), True)  # 12 exact words, then 70 % alike
    for n in range(3, 20):
        for _ in range(6):
            wrong = n // 4
            case(n, lambda x: put(x, rng.sample(range(n), wrong)), True)  # dense
        case(n, lambda x: put(x, rng.sample(range(n), n // 4 + 1)), False)
    for n in (15, 16, 17, 30, 60):
        for at in (1, n // 2, n - 2):
            case(n, lambda x: [*x[:at], other(), *x[at:]], True)  # a word put in
            case(n + 1, lambda x: [*x[:at], *x[at + 1 :]], True)  # left out
    got = d.overlaps(
        spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    ).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert sure <= found and found == plain(docs, items)
    text, by_id = dict(docs), dict(items)
    for r in got:
        run, item = text[r.doc_id][max(r.start, 0) : r.start + r.words], by_id[r.item_id]
        assert r.words >= min(d.MIN_WORDS, len(item)) and r.matched >= d.MIN_SIMILARITY * r.words and len(set(run) & set(item)) >= r.matched


def test_hot_phrases_make_no_rows(spark, monkeypatch):
    """Documents and items that share a common phrase and nothing else, and some that are alike beyond it."""
    rng = random.Random(4)
    phrase = "which of the following is true".split()
    other = lambda k: [f"w{rng.randint(0, 10**9)}" for _ in range(k)]
    items = [(i, phrase + other(8)) for i in range(2000)] + [(5000 + i, other(6) + phrase + other(5)) for i in range(500)]
    docs = [(i, other(1) + phrase) for i in range(200)]
    leaked = {}
    for k in range(40):
        item_id, item = items[k * 60]
        body = list(item)
        wrong = [x for x in range(len(body)) if body[x] not in phrase]
        for x in rng.sample(wrong, len(item) // 4):  # all that may differ, so that the phrase is often the only seed
            body[x] = f"x{rng.randint(0, 10**9)}"
        docs.append((1000 + k, other(rng.randint(0, 30)) + body + other(rng.randint(0, 30))))
        leaked[1000 + k] = item_id
    sizes = {}

    def counted(df, name, f=d.written):
        out = f(df, name)
        sizes[name] = out.agg(d.F.sum(d.F.size("hits"))).first()[0] or 0 if name == "hits" else out.count()
        return out

    monkeypatch.setattr(d, "written", counted)
    got = d.overlaps(spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == set(leaked.items())
    assert sizes["hot-seeds"] >= 2 and sizes["hits"] < 2000


@pytest.mark.parametrize("hot,rows", [(0, 500_000), (0, 0), (32, 0)])
def test_every_way_finds_the_same(spark, monkeypatch, hot, rows):
    """All seeds hot, and no table broadcast: the results of the other tests hold."""
    monkeypatch.setattr(d, "HOT", hot)
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows)
    test_against_brute_force(spark)
    test_recall_of_edited_copies(spark)
