import random

import numpy as np

from folio.llm import license_scan as ls
from folio.llm.queries import table


def plain(text):
    return [w.strip(".,!?;:\"'()[]{}*#$%&|<>-_/=+~`") for w in text.lower().split()]


def brute(doc, template):
    """The most words of template that an order-keeping local alignment over all places matches (Smith-Waterman without a band)."""
    a, b = plain(doc), plain(template)
    best, row = (0, 0), [(0, 0)] * (len(a) + 1)
    for w in b:
        new = [(0, 0)]
        for i, v in enumerate(a, 1):
            s, m = row[i - 1]
            cell = (s + ls.MATCH, m + 1) if v == w else (s + ls.MISMATCH, m)
            cell = max(cell if cell[0] > 0 else (0, 0), *[(x[0] + ls.GAP, x[1]) if x[0] + ls.GAP > 0 else (0, 0) for x in (new[i - 1], row[i])])
            new.append(cell)
            best = max(best, cell)
        row = new
    return best[1]


def longest_run(doc, template):
    a, b = plain(doc), plain(template)
    runs = {(i, j): 0 for i in range(-1, len(a)) for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            runs[i, j] = runs[i - 1, j - 1] + 1 if a[i] == b[j] else 0
    return max(runs.values())


def test_against_brute_force(spark):
    rng = random.Random(5)
    other = [f"w{i}" for i in range(50)]
    names = list(ls.TEMPLATES)
    docs = [(900, None), (901, ""), (902, "MIT"), (903, "  Released under the MIT License.")]
    for k in range(80):
        words = ls.TEMPLATES[names[k % len(names)]].split()
        for _ in range(rng.randint(0, max(1, len(words) // 8))):  # edits
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = rng.choices(other, k=rng.randint(0, 1))
        docs.append((k, " ".join(rng.choices(other, k=rng.randint(0, 30)) + (words if k % 4 else []) + rng.choices(other, k=rng.randint(0, 30)))))
    got = ls.licenses(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, start int")).collect()
    found = {(r.doc_id, r.license): r for r in got}
    for doc_id, text in docs:
        for name, template in ls.TEMPLATES.items():
            want = brute(text or "", template)
            n = len(plain(template))
            sure = want >= (ls.MIN_COVERAGE + 0.1) * n and longest_run(text or "", template) >= ls.K + ls.WINDOW - 1
            if sure or want < ls.MIN_COVERAGE * n:
                assert ((doc_id, name) in found) == (want >= ls.MIN_COVERAGE * n), (doc_id, name, want, n)
            if (doc_id, name) in found:
                assert found[doc_id, name].matched <= want
    text = dict(docs)
    for r in got:
        assert text[r.doc_id][r.start : r.end].split()[0] == text[r.doc_id].split()[r.start_word - text[r.doc_id].startswith(" ")]


def test_real_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {(r.doc_id, r.license) for r in ls.licenses(docs).collect()}
    for name in [n for n in ls.TEMPLATES if n.endswith("notice")]:
        assert {d for d, n in got if n == name} == {r.doc_id for r in docs.collect() if ls.TEMPLATES[name] in r.text}, name
    assert ls.licenses(docs.limit(0)).collect() == []


def align(doc, template, shift):
    """One alignment of the band, a cell at a time."""
    width = 2 * ls.BAND + 1
    empty = (0, -1, -1, 0)
    best, row = empty, [empty] * (width + 2)
    for j in range(len(template)):
        new = [empty] * (width + 2)
        for c in range(1, width + 1):
            i = j + shift + c - ls.BAND - 1
            if not 0 <= i < len(doc):
                continue
            score, start, _, matched = row[c]
            if doc[i] == template[j]:
                cell = (score + ls.MATCH, start if score > 0 else i, i + 1, matched + 1 if score > 0 else 1)
            else:
                cell = (score + ls.MISMATCH, start, i + 1, matched) if score + ls.MISMATCH > 0 else empty
            for other in (new[c - 1], row[c + 1]):
                if other[0] + ls.GAP > cell[0]:
                    cell = (other[0] + ls.GAP, *other[1:])
            new[c] = cell
            if cell[0] > best[0] or cell[0] == best[0] and cell[3] > best[3]:
                best = cell
        row = new
    return best[1:]


def test_alignments_side_by_side():
    rng = random.Random(9)
    for _ in range(60):
        template = np.array([rng.randint(0, 4) for _ in range(rng.randint(1, 12))])
        doc = np.array([rng.randint(-1, 4) for _ in range(rng.randint(0, 30))], np.int64)
        shifts = np.arange(-8, len(doc) + 8)
        assert [tuple(x) for x in ls.aligned(doc, template, shifts).tolist()] == [align(doc, template, int(s)) for s in shifts]
        low, high = np.sort(np.array([[rng.randint(0, len(doc)) for _ in range(2)] for _ in shifts]), axis=1).T
        cut = [align(doc[a:b], template, int(s) - a) for s, a, b in zip(shifts, low.tolist(), high.tolist(), strict=True)]
        assert [tuple(x) for x in ls.aligned(doc, template, shifts, low, high).tolist()] == [(x + a, y + a, m) if m else (x, y, m) for (x, y, m), a in zip(cut, low.tolist(), strict=True)]


def test_the_right_license_is_best(spark):
    parts = {
        "BSD-3-Clause": ls.TEMPLATES["BSD-3-Clause"] + " " + ls.TEMPLATES["BSD disclaimer"], "BSD-2-Clause": ls.TEMPLATES["BSD-2-Clause"], "ISC": ls.TEMPLATES["ISC"] + " " + ls.TEMPLATES["ISC disclaimer"],
        **{n: ls.TEMPLATES[n] for n in ls.TEMPLATES if n.endswith("header")}, "CC0-1.0 notice": ls.TEMPLATES["CC0-1.0 notice"], "MIT": ls.TEMPLATES["MIT"] + " " + ls.TEMPLATES["MIT disclaimer"], "0BSD": ls.TEMPLATES["0BSD"], "BSL-1.0": ls.TEMPLATES["BSL-1.0"],
    }
    docs = [(k, f"copyright 2020 someone\n\n{text}\n\nint main") for k, text in enumerate(parts.values())]
    rows = ls.licenses(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    best = {k: {r.license for r in rows if r.doc_id == k and r.is_best and "disclaimer" not in r.license} for k in range(len(docs))}
    assert best == {k: {n} for k, n in enumerate(parts)}
    assert any(r.license == "BSD-2-Clause" and r.coverage == 1.0 and not r.is_best for r in rows)


def test_a_long_text_of_notices(spark):
    n = 200_000
    text = "\n".join([ls.TEMPLATES["MIT notice"], "some words between them", ls.TEMPLATES["Apache-2.0 notice"]] * (n // 2))
    assert len(text) > 10_000_000
    rows = ls.licenses(spark.createDataFrame([(1, text), (2, ls.TEMPLATES["MIT notice"]), (2, ls.TEMPLATES["MIT notice"])], "doc_id long, text string").coalesce(1))
    assert {(r.doc_id, r.license): r.n for r in rows.groupBy("doc_id", "license").count().withColumnRenamed("count", "n").collect()} == {(1, "MIT notice"): n // 2, (1, "Apache-2.0 notice"): n // 2, (2, "MIT notice"): 2}
