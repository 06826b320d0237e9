"""Spelling variants, hard negatives and voted quality rules against plain Python and awkward tables."""

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from maintlake.llm import op11_variants, op12_negatives, op13_votes

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, n long, node long, word string, form string"
AWKWARD = [
    (1, None), (2, ""), (None, "only words here"), (3, " \t\n "), (4, "a"), (5, "word " * 30000), (6, "a"), (6, "a"), (7, "x" * 20000),
    (8, "\n\n"), (9, "é" * 900),
]


def table(spark, rows):
    """Documents with clashing extra columns."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", 2, 3, "y", "z") for i, t in rows], DOCS)


# --- 11 --------------------------------------------------------------------------------------------


def one_edit_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(docs):
    n = collections.Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in n if v != w and one_edit_apart(v, w)] for w in n}
    form = {}
    for w in n:
        if near[w]:
            top = min(near[w], key=lambda v: (-n[v], v))
            if n[top] >= 5 * n[w]:
                form[w] = top

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def misspelt_documents(seed):
    rng = random.Random(seed)
    letters = "abcdeéñÿß×"
    bases = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 11))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "abababab"]
    words = []
    for base in bases:
        words += [base] * 150
        chain = base
        for size in (28, 5):  # a variant of a variant: forms are followed
            k = rng.randrange(len(chain))
            chain = rng.choice([chain[:k] + rng.choice(letters) + chain[k:], chain[:k] + rng.choice(letters) + chain[k + 1 :], chain[:k] + chain[k + 1 :]])
            words += [chain] * size
    rng.shuffle(words)
    cased = [w.upper() if w.isascii() and rng.random() < 0.2 else w for w in words]
    size = len(cased) // 60
    return [(i, rng.choice([" ", ", ", "1", "\n"]).join(cased[i * size : (i + 1) * size])) for i in range(61)]


@pytest.mark.parametrize("block", [4096, 3])
def test_variants_against_brute_force(spark, block):
    docs = [*misspelt_documents(1), *AWKWARD, (None, "onlywords " * 6)]
    want = variants(docs)
    rows = op11_variants.spelling_variants(table(spark, docs), block_words=block).collect()
    assert len(rows) == len(want) > 60
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == want
    assert any(f and r != f for f, r, *_ in want.values())


def test_variants_of_the_sample_and_of_nothing(spark):
    found = registered.queries()["op11_spelling_variants"](spark, SF)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = variants(docs)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()} == want
    assert op11_variants.spelling_variants(table(spark, [])).count() == 0


def test_every_edit_shares_a_signature():
    rng = random.Random(3)
    for parts in (3, 5, 7):
        for _ in range(400):
            a = "".join(rng.choice("abcé") for _ in range(rng.randrange(6, 12)))
            k = rng.randrange(len(a))
            b = rng.choice([a[:k] + "x" + a[k:], a[:k] + "y" + a[k + 1 :], a[:k] + a[k + 1 :]])
            codes = op11_variants.letter_parts(*op11_variants._code_points([a, b]), parts)
            assert (codes[0] != codes[1]).sum() <= 2 and op11_variants.one_edit(a, b) == one_edit_apart(a, b)


# --- 12 --------------------------------------------------------------------------------------------


def negatives(rows):
    v = {}
    for i, e, label in rows:
        if i is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e):
            v[i] = (np.floor(256 * np.array(e)), (label + 1) % 10 if i % 7 == 0 else label)
    out = set()
    for a in v:
        if a % 100 == 0:
            ranked = sorted((-int(v[a][0] @ v[c][0]), c) for c in v if c != a)
            for p, i in [(-s, c) for s, c in ranked if v[c][1] == v[a][1]][:5]:
                fits = [(-s, c) for s, c in ranked if v[c][1] != v[a][1] and 80 * p <= -100 * s <= 100 * p]
                out |= {(a, i, r, c, p, s) for r, (s, c) in enumerate(fits[:5], 1)}
    return out


def mined(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def vector_rows(seed, n=900, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 10))
    rows = [(i, [float(x) for x in centres[i % 12] + spread * rng.normal(size=10)], int(rng.integers(0, 4))) for i in range(n)]
    rows[5] = (5, None, 1)
    rows[6] = (6, [1.0] * 9 + [None], 1)
    rows[8] = (8, [float("nan")] * 10, 1)
    rows[9] = (9, [float("inf")] * 10, 1)
    rows[11] = (11, rows[11][1], None)
    rows += [(n + i, rows[300][1], i % 3) for i in range(40)]  # one common vector
    rows += [rows[100], rows[101], (None, rows[0][1], 1), (n + 50, [0.0] * 10, 2)]
    return rows


@pytest.mark.parametrize("options", [{}, {"first_rows": 40, "block_rows": 32, "anchor_rows": 3, "codes_a_half": 6}])
def test_negatives_against_brute_force(spark, options):
    rows = vector_rows(2)
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], "vec_id long, embedding array<double>, label int, row string, cell int, score double")
    want = negatives(dict((r[0], r) for r in rows if r[0] is not None).values())
    assert mined(op12_negatives.hard_negatives(df, **options)) == want and len(want) > 60


def test_walks_stop_with_a_certificate():
    rng = np.random.default_rng(4)
    points = np.concatenate([c + 0.1 * rng.normal(size=(60, 8)) for c in 3 * rng.normal(size=(20, 8))])
    centres = tuple(op12_negatives.centroids(x, 8) for x in (points[:, :4], points[:, 4:]))
    codes = [op12_negatives.nearest(x, at) for x, at in zip((points[:, :4], points[:, 4:]), centres)]
    radii = tuple(
        np.array([max([0.0, *np.linalg.norm(x[c == i] - at[i], axis=1)]) for i in range(8)])
        for x, at, c in zip((points[:, :4], points[:, 4:]), centres, codes)
    )
    cell = codes[0] * 8 + codes[1]
    books = op12_negatives.Codebooks(centres, radii, np.bincount(cell, minlength=64))
    passed = 0
    for anchor in points[::40]:
        scores = points @ anchor
        bounds = [(c, up, low) for c, up, low in books.walk(anchor)]
        assert [b for _, b, _ in bounds] == sorted((b for _, b, _ in bounds), reverse=True)
        assert {c for c, *_ in bounds} == set(cell.tolist())
        assert all(low <= scores[cell == c].min() and scores[cell == c].max() <= up for c, up, low in bounds)
        least = np.sort(scores)[-5]
        found = books.certified_cells(anchor, least, math.inf)
        assert set(cell[scores >= least].tolist()) <= set(found.tolist())
        passed += books.sizes[found].sum()
    assert passed < 0.5 * len(points) * len(points[::40])


def test_negatives_of_nothing_and_of_huge_components(spark):
    ddl = "vec_id long, embedding array<double>, label int"
    assert op12_negatives.hard_negatives(spark.createDataFrame([], ddl)).count() == 0
    assert op12_negatives.hard_negatives(spark.createDataFrame([(100, [1.0, 2.0], 1)], ddl)).count() == 0
    with pytest.raises(ValueError):
        op12_negatives.hard_negatives(spark.createDataFrame([(100, [1e200, 2.0], 1), (1, [1.0, 2.0], 1)], ddl))


def test_negatives_equal_their_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = {tuple(r) for r in duck.execute(registered.oracle_sql()["op12_hard_negatives"]).fetchall()}
    assert mined(registered.queries()["op12_hard_negatives"](spark, SF)) == want and want


# --- 13 --------------------------------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered, seen, copies = set(), set(), 0
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered)


def more_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x.rstrip(" \t\v\f\r") for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    plain = [w for w in words if re.search(r"[0-9A-Za-z\u0080-\U0010ffff]", w)]
    ended = sum(x[-1] in ".!?:;\"')" for x in lines)
    return (
        len(words) - len(plain), sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words),
        max(collections.Counter(plain).values(), default=0), len(re.findall("[0-9]", text)), len(lines), ended,
        sum(x[-1] < "\u0080" for x in lines) - ended,
    )


def em_by_document(cast, rounds=500):
    """The same estimates document by document, in plain Python."""
    yes = [0.1 if 1 in v else 0.9 for v in cast]
    for _ in range(rounds):
        no = [1 - y for y in yes]
        good = (sum(yes) + 1) / (len(cast) + 2)
        right = [
            [
                (sum(w for w, v in zip(who, cast) if v[r] == hit) + 1) / (sum(w for w, v in zip(who, cast) if v[r] != 2) + 2)
                for r in range(len(cast[0]))
            ]
            for who, hit in ((yes, 0), (no, 1))
        ]
        yes = []
        for v in cast:
            a, b = good, 1 - good
            for r, x in enumerate(v):
                if x != 2:
                    a *= right[0][r] if x == 0 else 1 - right[0][r]
                    b *= right[1][r] if x == 1 else 1 - right[1][r]
            yes.append(a / (a + b))
    return yes


def rows_of(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    return docs + AWKWARD + [(20, "a b c a b c\nx\nx\n x\n#x# é.\r\nx"), (21, "l1\nl2\nl1\n\n\nl1"), (22, "one two three one two three")]


def test_votes_against_plain_python(spark):
    docs = rows_of(spark)
    cast = []
    for _, t in docs:
        value = dict(zip(op13_votes.COUNTS, (*base_counts(t), *more_counts(t))))
        row = []
        for part, whole, low, high in op13_votes.RULES.values():
            base = sum(value[c] for c in whole.split(" + "))
            ratio = value[part] / base if base else None
            row.append(2 if ratio is None else 0 if ratio <= low else 1 if ratio >= high else 2)
        cast.append(row)
    posterior = em_by_document(cast)
    want = collections.Counter()
    for (i, t), p in zip(docs, posterior):
        base = base_counts(t)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        want[(i, *base, failed, not failed and p >= 0.5, round(p, 5))] += 1
    got = collections.Counter((*tuple(r)[:-1], round(r.posterior, 5)) for r in op13_votes.voted_documents(table(spark, docs)).collect())
    assert got == want and {k[-2] for k in want} == {True, False}
    assert op13_votes.voted_documents(table(spark, [])).count() == 0


def test_votes_agree_with_labels(spark):
    """Nobody shows the labels to the model; documents marked good stay and marked bad go."""
    out = registered.queries()["op13_voted_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = out.filter("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    share = {r.quality: r.kept for r in seen.collect()}
    assert share[1] > 0.98 and share[0] < 0.3
