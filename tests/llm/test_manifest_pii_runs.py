"""Merkle manifest, personal data and periodic runs against brute force, and their edge cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarframe.llm import merkle, periodic_runs, pii, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g int, rank int, h string, kids int, id long, proof int, spans int"


def table(spark, rows):
    """Documents with columns besides whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, 2, "h", 3, 4, 5, 6) for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    i, text, lang, source, n = row
    values = [None if v is None else str(v).encode() for v in (i, source, lang, n, text)]
    return hashlib.sha256(b"".join(b"-" if v is None else b"%d:%s" % (len(v), v) for v in values)).hexdigest()


def tree(leaves):
    """Root and the proof of every leaf, as lists of (left, right)."""
    paths, level, where = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, w in enumerate(where):
            run = w // 8 * 8
            paths[i].append(("".join(level[run:w]), "".join(level[w + 1 : run + 8])))
            where[i] = w // 8
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], paths


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(1400):
        lang = rng.choice(["en"] * 30 + ["de", "de", "é", None])
        out.append((rng.randrange(2000), f"Text {i} É", lang, rng.choice(["a", None]), i))
    out += [(None, "no id", "en", "a", 1), (None, None, "en", None, None), (5, "", "only one", "a", 0), out[3], out[3], (9, "x" * 1_200_000, "en", "a", 2)]
    out += [(77, "same", "copies", "a", 4)] * 600
    return out


def test_merkle_manifest(spark, rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf_of(row)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: tree([h for _, _, h in sorted(groups[g])]) for g in names}
    root, tops = tree([built[g][0] for g in names])
    wanted = collections.Counter()
    for k, g in enumerate(names):
        for (_, _, h), path in zip(sorted(groups[g]), built[g][1]):
            wanted[h, built[g][0], root, tuple(path + tops[k])] += 1
    docs = table(spark, rows).repartition(5)
    found = merkle.manifest(docs, altered={"text": F.lower("text")}).withColumn("again", merkle.folded(F.col("leaf"), F.col("proof")))
    found = found.withColumns({"digest": merkle.proof_digest(F.col("proof")), "other": merkle.folded(F.col("altered_leaf"), F.col("proof"))}).collect()
    assert collections.Counter((r["leaf"], r["subroot"], r["root"], tuple((a, b) for a, b in r["proof"])) for r in found) == wanted
    for r in found:
        assert r["again"] == root and r["digest"] == sha("".join(a + b for a, b in r["proof"]))
        assert r["altered_leaf"] is None or r["other"] != root
    altered = {r["leaf"] for r in found if r["altered_leaf"] is not None}
    assert altered == {leaf_of(r) for r in rows if r[1] is not None and r[1].lower() != r[1]}


def test_merkle_small_tables(spark):
    assert merkle.manifest(table(spark, [])).count() == 0
    one = (1, None, None, None, None)
    (row,) = merkle.manifest(table(spark, [one])).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf_of(one) and row["proof"] == []


def runs_by_brute_force(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def repetitive(rng):
    """Words with runs in runs, cut and spoiled."""
    letters = rng.randint(1, 4)

    def part(depth):
        if not depth:
            return [rng.randrange(letters) for _ in range(rng.randint(1, 6))]
        out = []
        for _ in range(rng.randint(1, 3)):
            once = part(depth - 1)
            many = once * rng.choice([1, 1, 2, 3, 5, 10, rng.randint(1, 40)])
            out += many[: len(many) - rng.randint(0, len(once))] if rng.random() < 0.5 else many
        return out

    words = part(rng.randint(1, 4))[: rng.choice([300, 700])]
    for _ in range(rng.choice([0, 0, 1, 3])):
        if words:
            words[rng.randrange(len(words))] = letters
    return words


def test_periodic_runs_by_brute_force():
    rng, long_ones = random.Random(13), 0
    for _ in range(250):
        words = repetitive(rng)
        if words:
            found = [c.tolist() for c in periodic_runs.periodic_runs(np.array([*words, 9], np.int32), len(words))]
            wanted = runs_by_brute_force(words)
            assert sorted((s, e - s, q) for s, e, q in zip(*found)) == wanted
            long_ones += sum(q >= periodic_runs.SHORT for _, _, q in wanted)
    assert long_ones > 100


def test_stretches_that_touch():
    """The only witnesses of the long periods are the borders between runs of a short one."""
    words = ("a a b b " * 18 + "a a a b b " * 1) * 6
    words = words.split()
    ids = np.array([ord(w) - 97 for w in words] + [9], np.int32)
    found = [c.tolist() for c in periodic_runs.periodic_runs(ids, len(words))]
    assert sorted((s, e - s, q) for s, e, q in zip(*found)) == runs_by_brute_force(words)


def test_run_report(spark):
    rng = random.Random(5)
    texts = [" ".join(map(str, repetitive(rng))) for _ in range(40)] + [None, "", " \t\n", "é " * 30, "a\x0bb\x0c" * 50, "one two"]
    texts += ["w " * 600_000 + "end"]  # longer than a piece
    docs = table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, texts[0], None, None, None), (0, texts[0], None, None, None)])
    found = periodic_runs.run_report(docs.repartition(3), with_text=True).collect()
    assert len(found) == len(texts) + 2
    assert periodic_runs.run_report(table(spark, [])).count() == 0
    for r in found:
        text = texts[r["doc_id"] or 0] or ""
        words = text.encode().split()
        if len(words) > 10_000:
            assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (1, 0, 600_000, 1, 600_000_000)
            assert r["collapsed_text"] == "w end"
            continue
        runs = runs_by_brute_force(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        assert r["n_words"] == len(words) and [tuple(x) for x in r["runs"]] == runs and r["n_runs"] == len(runs)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_text"] == kept and r["collapsed_sha256"] == sha(kept)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)


def test_looped_tails(spark):
    import zlib

    rng = random.Random(1)
    rows = [(i, " " * (i % 3) + " ".join(rng.choice("abc") + str(k) for k in range(rng.randint(0, 60))), None, None, None) for i in range(300)]
    rows += [(None, "a b", None, None, None), (10_000, None, None, None, None)]
    for row in queries.looped_tails(table(spark, rows)).collect():
        text = dict((r[0], r[1]) for r in rows)[row["doc_id"]]
        words, h = (text or "").split(), zlib.crc32(str(row["doc_id"]).encode())
        if row["doc_id"] is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert (row["text"] or "").split() == words


PLAIN = {
    0: re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    1: re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    2: re.compile(r"[0-9]([\x20-]?[0-9])+"),
    3: re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
            fits = {
                0: True,
                1: kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                2: 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                3: 9 <= len(digits) <= 15,
            }
            if fits[kind]:
                out.append((kind, *m.span()))
    return out


def some_pii(rng):
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    card = n(15)
    card += next(d for d in "0123456789" if pii.luhn(card + d))
    return [
        f"{rng.choice(['ann', 'bob.lee', 'c_d'])}.{n(2)}@mail{n(1)}.example.com",
        ".".join(str(rng.randrange(256)) for _ in range(4)),
        card,
        f"+1 ({rng.randint(200, 999)}) 555-{n(4)}",
    ]


@pytest.fixture(scope="module")
def letters():
    rng = random.Random(8)
    prose = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor at vero eos et accusam".split()
    out = []
    for _ in range(400):
        words = [rng.choice(prose) for _ in range(rng.randint(3, 30))]
        for item in some_pii(rng):
            if rng.random() < 0.4:
                words.insert(rng.randrange(len(words)), item + rng.choice(["", ",", "."]))
        out.append(" ".join(words))
    return out


def test_base_spans_as_the_patterns_find_them(letters):
    rng = random.Random(3)
    strings = ["".join(rng.choice("ab@@..-+_%19  ()2") for _ in range(rng.randint(0, 40))) for _ in range(20_000)]
    for text in strings + letters + ["é" * 9 + "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "1" * 3000 + ".2.3.4", "", "@" * 50]:
        assert pii.base_spans(text) == plain_spans(text), text


def test_field_finds_other_writings_and_leaves_numbers_alone(spark, letters):
    train = spark.createDataFrame([(i, t) for i, t in enumerate(letters[:300])], "doc_id long, text string")
    weights = pii.fit(train)
    rng, right, wrong, missed = random.Random(21), 0, 0, 0
    for text in letters[300:]:
        for k, a, b in pii.base_spans(text):
            for way in pii.rewritten(k, text[a:b], rng):
                new, wanted = f"so {way} it", (k, 3, 3 + len(way))
                found = pii.all_spans(new, pii.base_spans(new), weights)
                right += wanted in found
                missed += wanted not in found
                wrong += len(set(found) - {wanted} - set(pii.base_spans(new)))
    assert missed <= 0.03 * right and wrong <= 0.03 * right
    for text in ["on 2021-03-04 12:30:45 it", "x 4737097684299438 y", "look at example.com now", "1 234 567 890 people"]:
        assert pii.all_spans(text, pii.base_spans(text), weights) == []


def test_probabilities_sum_over_all_divisions():
    text = "a (743) 555-3824 4737 0976 8429 9439 b"
    (found,) = list(pii.stretches(pii.segments(text)))
    rng = random.Random(2)
    scores = [rng.uniform(-2, 2) for _ in found]

    def divisions(at):
        if at == len(found):
            yield []
            return
        yield from divisions(at + 1)
        later = [i for i in range(at + 1, len(found)) if found[i].start >= found[at].end]
        for rest in divisions(later[0] if later else len(found)):
            yield [at, *rest]

    total, mass, best = 0.0, np.zeros(len(found)), (0.0, [])
    for division in divisions(0):
        if all(found[a].end <= found[b].start for a, b in zip(division, division[1:])):
            score = sum(scores[i] for i in division)
            total += np.exp(score)
            mass[division] += np.exp(score)
            best = max(best, (score, division))
    n, steps = pii._places(found)
    assert np.allclose(pii.probabilities(n, steps, np.array(scores)), mass / total)
    for s, score in zip(found, scores):
        s.features = [f"own {id(s)}"]
    weights = {s.features[0]: score for s, score in zip(found, scores)}
    assert pii.best_segments(found, weights) == [(found[i].kind, found[i].start, found[i].end) for i in best[1]]


def test_personal_data(spark, letters):
    many = " ".join(str(i) for i in range(10, 260_000))  # longer than a megabyte, one stretch of candidates
    texts = [*letters[:60], None, "", many, "é a.b@c.de é"]
    docs = table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, texts[0], None, None, None), (0, texts[0], None, None, None)])
    weights = pii.fit(docs)
    found = pii.personal_data(docs.repartition(3), weights).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        text = texts[r["doc_id"] or 0] or ""
        base = plain_spans(text) if text != many else pii.base_spans(text)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[0] == k for s in base) for k in range(4)]
        assert r["base_sha256"] == sha(pii.listed(base))
        spans = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert set(base) <= set(spans) and spans == sorted(spans)
        added = sorted((a, b) for k, a, b in set(spans) - set(base))
        assert all(x[1] <= y[0] for x, y in zip(added, added[1:]))
    nothing = table(spark, [])
    assert pii.personal_data(nothing, pii.fit(nothing)).count() == 0
