"""Quality rules, mixing, SimHash and suffix arrays against plain restatements."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
import zstandard

from paddock.llm import mixing, quality_rules, queries, simhash, suffix_array, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, KEPT int, Size int"


def prose(rnd, words):
    return " ".join("".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(1, 7))) for _ in range(words))


def odd_rows():
    """Nulls, empty and long texts, repeats, ties, near copies."""
    rnd = random.Random(4)
    base = prose(rnd, 300)
    near = base.split()
    near[100] = "changed"
    many = [(100 + i, base + f" end{i}", "en", "s2", 1, 1, 1) for i in range(12)]
    return [
        (1, None, None, None, None, 1, 1), (2, "", "en", "s1", 0, 1, 1), (3, " \t\n", "en", "s1", 3, 1, 1), (None, base, "en", "s1", 5, 1, 1),
        (4, base, "en", "s1", 5, 1, 1), (4, base, "en", "s1", 5, 1, 1), (5, " ".join(near), "en", None, 5, 1, 1), (6, "UPPER " + base.upper(), "en", "s2", 5, 1, 1),
        (7, "a b", "en", "s3", 3, 1, 1), (8, "so it goes " * 4000, "en", "s3", 9, 1, 1), (9, prose(rnd, 9000), "de", "s3", 9, 1, 1),
        (10, "übrig é\x00 日本 🙂\x0b" * 40, "de", "s3", 9, 1, 1), *many,
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def key(row):
    return tuple((v is None, str(v)) for v in row)


# quality rules


def plain_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules_equal_their_restatement(odd):
    found = quality_rules.quality_rules(odd, "text", {"doc_id": odd["doc_id"], "text": odd["text"]}).collect()
    assert len(found) == len(odd_rows())
    for r in found:
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == plain_rules(r["text"])
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules.quality_rules(odd.limit(0), "text", {}).collect() == []


def test_compression_bands():
    compress = zstandard.ZstdCompressor(level=3).compress
    rnd = random.Random(1)
    english = "It was a bright cold day in April, and all the clocks of the town were striking thirteen while people hurried home. "
    noise = "".join(rnd.choice("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/") for _ in range(6000))
    assert quality_rules.outside((english * 60).encode(), compress)[1]
    assert quality_rules.outside(noise.encode(), compress)[1]
    assert not quality_rules.outside(b"short", compress)[1]
    assert quality_rules.band(100) == (0.0, float("inf"))
    lows, highs = zip(*[quality_rules.band(n) for n in range(256, 200_000, 999)])
    assert list(highs) == sorted(highs) and list(lows) == sorted(lows)


# mixing


def test_closest_sum_is_the_best_there_is():
    rnd = random.Random(2)
    for _ in range(200):
        sizes = sorted(rnd.sample(range(1, 40), rnd.randint(1, 5)))
        counts = [rnd.randint(0, 4) for _ in sizes]
        budget = rnd.randint(0, 120)
        reached = {0}
        for s, c in zip(sizes, counts):
            reached = {r + s * k for r in reached for k in range(c + 1)}
        taken = mixing.closest_sum(sizes, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert sum(s * t for s, t in zip(sizes, taken)) == max(r for r in reached if r <= budget)


def test_budgets_beyond_the_window():
    rnd = random.Random(3)
    sizes = sorted(rnd.sample(range(1, 50_000), 300))
    counts = [rnd.randint(1, 50) for _ in sizes]
    total = sum(s * c for s, c in zip(sizes, counts))
    for budget in (0, 1, total // 3, total - 1, total, 2 * total):
        taken = mixing.fit_budget(sizes, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert abs(min(budget, total) - sum(s * t for s, t in zip(sizes, taken))) <= 2


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight, capped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, set()
    while True:
        free = [s for s in names if s not in capped]
        rate = (1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)) / max(sum(weight[s] for s in free), 1)
        above = {s for s in free if weight[s] * rate > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * rate for s in names}
        capped |= above


@pytest.mark.parametrize("folder", [None, "/root/testdata/sf0.001"])
def test_mix_meets_its_targets(spark, odd, folder):
    docs = odd if folder is None else spark.read.parquet(f"{folder}/documents.parquet")
    mixed = mixing.mix(docs, "doc_id", "text", "source")
    rows, again = (sorted(map(key, m.select("doc_id", "source", "size", "target", "copies").collect())) for m in (mixed, mixed))
    assert rows == again
    found, sizes, taken = mixed.collect(), Counter(), Counter()
    assert len(found) == docs.count()
    for r in found:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["copies"] in (0, 1, 2)
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
    targets = plain_targets(sizes)
    longest = max(r["size"] for r in found)
    for r in found:
        assert r["target"] == pytest.approx(targets[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= (longest if folder is None else max(12, targets[s] / 100))
    assert mixing.mix(docs.limit(0), "doc_id", "text", "source").collect() == []


# SimHash


def plain_fingerprint(text, size=3, seed=42):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("folder", [None, "/root/testdata/sf0.001"])
def test_simhash_equals_brute_force(spark, odd, folder):
    docs = odd if folder is None else spark.read.parquet(f"{folder}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    groups, least = plain_groups(prints, 3), {}
    for g, r in zip(groups, rows):
        if r["doc_id"] is not None:
            least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    expected = [(r["doc_id"], f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, groups)]
    found = simhash.near_duplicates(docs, "doc_id", "text").collect()
    assert sorted(map(key, found)) == sorted(map(key, expected))


@pytest.mark.parametrize("wide", [False, True])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, wide):
    monkeypatch.setattr(simhash, "TILE", 5)  # many tiles, several of one key
    monkeypatch.setattr(simhash, "WIDE_TILE", 5)
    rnd = random.Random(8)
    width, radius = (128, 25) if wide else (64, 3)
    prints = {0, (1 << width) - 1}
    for _ in range(25):
        seed = rnd.getrandbits(width)
        for _ in range(rnd.randint(1, 6)):
            prints.add(seed)
            for _ in range(rnd.randint(1, radius)):
                seed ^= 1 << rnd.randrange(width)
    prints = sorted(prints)
    data = [p.to_bytes(width // 8, "big") if wide else p - (1 << 64) * (p >> 63) for p in prints]
    classes = spark.createDataFrame([(d,) for d in data], "fp binary" if wide else "fp long")
    found = simhash.wide_links(classes, radius, width // 8) if wide else simhash.links(classes, radius)
    number = {d: i for i, d in enumerate(data)}
    pairs = [(number[bytes(r["a"]) if wide else r["a"]], number[bytes(r["b"]) if wide else r["b"]]) for r in found.collect()]
    a, b = (np.array([p[k] for p in pairs], int) for k in (0, 1))
    assert len(set(simhash.forest(a, b, len(data)).tolist())) == len(set(plain_groups(prints, radius)))
    assert simhash.forest(a, b, len(data)).tolist() == plain_groups(prints, radius)


def test_one_of_each_group_stays(odd):
    kept = simhash.one_of_each_group(odd, "doc_id", "text")
    assert kept.columns == odd.columns
    # blank texts; the base text with its near copies; the short ones
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 7, 8, 9, 10]
    assert simhash.one_of_each_group(odd.limit(0), "doc_id", "text").collect() == []


def word_sets(text, size=5):
    words = text.split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def connected(sets, likeness):
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) / len(a | sets[j]) >= likeness and root[i] != root[j]:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    return root


def test_groups_are_those_of_the_exact_likeness(spark):
    """Texts that share a passage, from unlike to nearly equal; likeness 0.8 decides."""
    rnd = random.Random(14)
    rows = []
    for k in range(60):
        base = prose(rnd, rnd.randint(60, 400)).split()
        for share in (0, 0.03, 0.06, 0.1, 0.11, 0.12, 0.2, 0.4):
            fresh_words = prose(rnd, int(share * len(base))).split() if share else []
            rows.append((len(rows), " ".join(base[: len(base) - len(fresh_words)] + fresh_words)))
    roots = connected([word_sets(t) for _, t in rows], 0.8)
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots))


@pytest.mark.parametrize("likeness", [0.3, 0.8])
def test_sets_connect_as_all_pairs_do(likeness):
    rnd = random.Random(15)
    for _ in range(40):
        sets = [set(rnd.sample(range(14), rnd.randint(1, 12))) for _ in range(rnd.randint(1, 25))]
        found = simhash.alike([np.array(sorted(s), np.uint64) for s in sets], likeness)
        assert found.tolist() == connected(sets, likeness)


# suffix arrays


def test_suffix_array_and_common_prefixes():
    rnd = random.Random(1)
    for round_ in range(120):
        stretches = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(1, 6))]
        stretches += stretches[:2] if round_ % 3 == 0 else []
        signs = [s for i, text in enumerate(stretches) for s in [(1, c) for c in text] + [(0, i)]]
        order = sorted(range(len(signs)), key=lambda i: signs[i : i + 64])

        def shared(a, b):
            n = 0
            while signs[a + n] == signs[b + n] and signs[a + n][0]:
                n += 1
            return n

        symbols, packed, owner, sa = suffix_array.build(stretches)
        assert sa.tolist() == order
        assert suffix_array.common_prefixes(symbols, packed, owner, sa).tolist() == [0] + [shared(a, b) for a, b in zip(order, order[1:])]


def plain_repeats(texts, length):
    starts = defaultdict(int)
    for data in texts:
        for i in range(len(data) - length + 1):
            starts[data[i : i + length]] += 1
    out = []
    for data in texts:
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if starts[data[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(data)]
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("crowd", [1024, 1])
def test_repeats_equal_brute_force(spark, odd, crowd):
    rnd = random.Random(6)
    passage = prose(rnd, 160)
    extra = [(200 + i, prose(rnd, rnd.randint(0, 60)) + passage[rnd.randint(0, 90) : rnd.randint(500, 900)] + prose(rnd, 30), "en", "s", 1, 1, 1) for i in range(25)]
    rows = odd_rows() + extra + [(300, "ab" * 1500, "en", "s", 1, 1, 1), (301, "x" * 401, "en", "s", 1, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    length = suffix_dedup.LENGTH
    found = suffix_dedup.repeats(docs, "text", length, 20_000, crowd)
    found = {bytes(r["sha"]): (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found.collect()}
    texts = [(r[1] or "").encode() for r in rows]
    for data, (size, removed, spans, kept) in zip(texts, plain_repeats(texts, length)):
        assert found.get(hashlib.sha256(data).digest(), (0, 0, data)) == (removed, spans, kept)


def test_rows_without_repeats(odd):
    cut = suffix_dedup.without_repeats(odd, "text").collect()
    assert len(cut) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in cut}
    assert (by_id[1]["n_bytes"], by_id[1]["n_removed"], bytes(by_id[1]["kept"])) == (0, 0, b"")
    assert by_id[4]["n_removed"] == by_id[4]["n_bytes"] and by_id[4]["n_spans"] == 1
    assert by_id[9]["n_removed"] == 0
    assert suffix_dedup.without_repeats(odd.limit(0), "text").collect() == []


def test_long_texts_are_sliced(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 1000)
    text = prose(random.Random(9), 900).encode()
    slices = list(suffix_dedup.sliced([b"short", text], 400))
    windows = sum(int(s.valid.sum()) for s in slices)
    assert windows == len(text) - 399


@pytest.mark.parametrize("together", [False, True])
def test_windows_at_the_end_of_an_array_remain(together):
    """What repeats exactly once, at the end of a text, is never struck out, whether a text has an array to itself or not."""
    rnd = random.Random(12)
    length = suffix_dedup.LENGTH
    for tail in [length, length + 1, length + 100, length + 241, 3 * length, *(rnd.randint(length, 4 * length) for _ in range(15))]:
        passage = prose(rnd, tail)[:tail]
        texts = [prose(rnd, rnd.randint(0, 300)) + "<" + passage, prose(rnd, 200) + ">" + passage + "!" + prose(rnd, 200), prose(rnd, 300)]
        parts = [(i, 0, t.encode()) for i, t in enumerate(texts)]
        arrays = [suffix_dedup.Slices(parts, length)] if together else [suffix_dedup.Slices([p], length) for p in parts if len(p[2]) >= length]

        def unique(anchors):
            counts = Counter(h for s, (anchor, covered) in zip(arrays, anchors) for h in s.hashes[suffix_dedup.once(anchor[covered])].tolist())
            return np.array(sorted(h for h, n in counts.items() if n == 1), np.uint64)

        struck = unique([(s.anchor, s.valid) for s in arrays])
        inner_struck = unique([s.inner(s.outer(struck)) for s in arrays])
        windows = Counter(t.encode()[i : i + length] for t in texts for i in range(len(t) - length + 1))
        for s in arrays:
            left = s.remaining(struck, inner_struck)
            for i in np.flatnonzero(s.valid):
                assert left[i] or windows[s.data[i : i + length]] == 1


def test_repeats_at_the_end_of_long_texts(spark):
    """Texts that fill an array each; the passage at the end of the first stands once more, inside the second."""
    rnd = random.Random(13)
    size, passage = suffix_dedup.SLICE + 200, prose(rnd, 200)[:500]
    filling = lambda n: rnd.randbytes(n // 2 + 1).hex()[:n]
    one = filling(size - len(passage) - 1) + "<" + passage
    two = filling(size // 2) + ">" + passage + "!" + filling(size // 2 - len(passage))
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    cut = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.without_repeats(docs, "text").collect()}
    assert cut == {i: (500, 1, t.replace(passage, "").encode()) for i, t in ((1, one), (2, two))}


def test_digests_of_the_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    texts = [(r["text"] or "").encode() for r in docs]
    expected = {r["doc_id"]: (*p[:3], hashlib.sha256(p[3]).hexdigest()) for r, p in zip(docs, plain_repeats(texts, 400))}
    assert {r["doc_id"]: tuple(r)[1:] for r in queries.op9_suffix_dedup(spark, folder).collect()} == expected


@pytest.mark.parametrize("length", [64, 96, 150, 161, 400])
def test_repeats_of_any_length(spark, length):
    rnd = random.Random(length)
    shared = prose(rnd, 150)
    texts = [prose(rnd, 60) + shared[:n] + prose(rnd, 40) for n in (length - 1, length, length + 40, 500)] + [prose(rnd, 80), "ab" * 300]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.without_repeats(df, "text", length).collect()}
    for i, (_, removed, spans, kept) in enumerate(plain_repeats([t.encode() for t in texts], length)):
        assert found[i] == (removed, spans, kept)


def test_too_short_windows_are_refused(spark):
    with pytest.raises(ValueError):
        suffix_dedup.repeats(spark.createDataFrame([("a",)], "text string"), "text", 63)


def best_sum(sizes, counts, budget):
    sums = {0}
    for size, count in zip(sizes, counts):
        sums = {s + size * n for s in sums for n in range(count + 1)}
    return min(sums, key=lambda s: (abs(s - budget), s))


def test_budgets_of_few_long_documents():
    """No size of document or budget switches the programme off."""
    assert mixing.fit_budget([80_000, 90_000, 110_000, 150_000], [1, 1, 1, 1], 200_000) == [0, 1, 1, 0]
    rnd = random.Random(1)
    for _ in range(60):
        sizes = sorted(rnd.sample(range(60_000, 900_000), rnd.randint(1, 9)))
        counts = [rnd.randint(1, 3) for _ in sizes]
        budget = rnd.randint(0, sum(s * c for s, c in zip(sizes, counts)))
        taken = mixing.fit_budget(sizes, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert sum(s * t for s, t in zip(sizes, taken)) == best_sum(sizes, counts, budget)
    # a common divisor, and far more sums than are listed
    assert sum(s * t for s, t in zip([10**6, 3 * 10**6], mixing.fit_budget([10**6, 3 * 10**6], [50, 70], 123 * 10**6))) == 123 * 10**6
    for _ in range(10):
        sizes = sorted(rnd.sample(range(70_000, 900_000), 60))
        budget = sum(sizes) // rnd.randint(2, 7)
        taken = mixing.fit_budget(sizes, [1] * 60, budget)
        assert set(taken) <= {0, 1} and abs(budget - sum(s * t for s, t in zip(sizes, taken))) < 200
