"""Each corpus operator on hard rows: against brute force, an exact round trip or held-out accuracy."""

import re
import time
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from brute import prose
from pyspark.sql import functions as F

from millrace.llm import decontamination, fixity, html_text, language_id, license_scan, packing
from millrace.llm import part_enum, quality_rules, rule_ensemble, token_store
from millrace.llm.components import components
from millrace.llm.text import CLASSES
from millrace.session import work_path

SF = "/root/testdata/sf0.001"


def ids_of(file, text):
    from tokenizers import Tokenizer

    encoded = Tokenizer.from_file(public_tokenizers.path(file)).encode(text or "", add_special_tokens=False)
    return np.array([*encoded.ids, 2], dtype="<u4")


def test_quality_rules_counts_are_exact(hard_docs, hard_rows, no_docs):
    rows = quality_rules.quality_rules(hard_docs).collect()
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = Counter((r.doc_id, *[r[c] for c in counted]) for r in rows)
    assert found == Counter((i, *brute.base_rules(t)) for i, t in hard_rows)
    assert not any(r.kept and r.base_failed for r in rows)
    assert 12 not in {r.doc_id for r in rows if r.kept}
    assert quality_rules.quality_rules(no_docs).count() == 0
    kept = quality_rules.good(hard_docs)
    assert kept.columns == hard_docs.columns and kept.count() == sum(r.kept for r in rows)


def test_divergence_rejects_another_distribution(spark):

    plain = [(i, prose(i, 200), "en") for i in range(60)]
    strange = [(1000 + i, prose(i, 200).upper().replace(" ", "!! "), None) for i in range(5)]
    docs = spark.createDataFrame(plain + strange, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality_rules.quality_rules(docs).where("kept").collect()}
    assert kept == set(range(60))


def test_every_language_has_a_reference(spark):
    """Forty languages of other words each, the last ones with fewest documents."""
    import random

    def text(lang, i):
        common = ["".join(random.Random(f"{lang} {k}").choices("abcdefghijklmnop", k=4)) for k in range(12)]
        rng = random.Random(i)
        return " ".join(rng.choice(common) if rng.random() < 0.7 else f"{rng.choice(common)}{rng.randrange(900)}" for _ in range(1500))

    rows = [(100 * k + i, text(k, 100 * k + i), f"l{k:02}") for k in range(40) for i in range(8 if k < 32 else 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["lang"]: r for r in quality_rules.references(docs)}
    assert len(found) == 40
    for lang in ("l00", "l39"):
        counts = Counter(w for _, t, own in rows if own == lang for w in t.split())
        top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:12]
        assert found[lang]["words"] == {w: n / counts.total() for w, n in top}
    assert quality_rules.good(docs).count() == len(rows)


def test_quality_rules_without_languages(hard_docs):
    rows = quality_rules.quality_rules(hard_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(r.kept != r.base_failed and r.char_distance is None for r in rows)


def test_rule_ensemble_learns_and_scores_all(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    learned = labels.where(~rule_ensemble.held_out()).select("doc_id", F.col("quality").alias("label"))
    ensemble = rule_ensemble.fit(docs, learned)
    assert ensemble.rules
    scored = rule_ensemble.score(docs, ensemble)
    held = scored.join(labels.where(rule_ensemble.held_out()), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert scored.count() == docs.count()


def test_rule_ensemble_edges(spark, hard_docs, hard_rows, no_docs):
    none = spark.createDataFrame([], "doc_id long, label int")
    empty = rule_ensemble.fit(hard_docs, none)
    assert {r.score for r in rule_ensemble.score(hard_docs, empty).collect()} == {0.5}
    one = rule_ensemble.fit(hard_docs, spark.createDataFrame([(1, 1), (2, 1), (2, None)], "doc_id long, label int"))
    assert {r.predicted for r in rule_ensemble.score(hard_docs, one).collect()} == {1}
    rows = rule_ensemble.score(hard_docs, rule_ensemble.Ensemble(0.1, [(-1.0, (("n_words", False, 0.0),))])).collect()
    assert len(rows) == len(hard_rows) and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in rows if not r.predicted} == {4, 5, 6}
    assert rule_ensemble.score(no_docs, empty).count() == 0
    assert rule_ensemble.good(hard_docs, empty).columns == hard_docs.columns


def test_the_fit_reads_a_bounded_number_of_rows(spark):
    texts = [(7, prose(i, 30 + i % 50)) for i in range(2000)] + [(8, prose(1, 40))] * 3000
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, label int")
    n = rule_ensemble.drawn(docs, labels, rule_ensemble.Fit(max_rows=50)).count()
    assert 0 < n < 100
    assert rule_ensemble.drawn(docs, labels).count() <= 2001


def test_compiled_rules_equal_plain_ones(spark, hard_docs):
    rules = [(1.5, (("n_words", True, 50.0), ("share_symbol", False, 0.1))), (-2.0, (("distinct", False, 0.9),)), (0.25, ())]
    ensemble = rule_ensemble.Ensemble(0.5, rules)
    stats = rule_ensemble.with_statistics(hard_docs)
    for row in stats.select("*", ensemble.score().alias("found")).collect():
        holds = lambda c: row[c[0]] > c[2] if c[1] else row[c[0]] <= c[2]
        total = 0.5 + sum(w for w, conditions in rules if all(map(holds, conditions)))
        assert row.found == pytest.approx(1 / (1 + np.exp(-total)))


def test_statistics_equal_plain_counts(spark, hard_docs, hard_rows):
    def plain(text):
        found = brute.BLANK_WORD.findall(text)
        chars = max(1, len(text))
        classes, left = [], text
        for chars_of in CLASSES.values():
            kept = re.sub(chars_of, "", left)
            classes.append((len(left) - len(kept)) / chars)
            left = kept
        lines = [x for x in text.split("\n") if x]
        blank = classes[list(CLASSES).index("blank")]
        n = max(1, len(found))
        repeats = 1 - len(set(lines)) / max(1, len(lines))
        return [*classes, len(left) / chars, (chars - blank * chars) / n, len(found), len(set(found)) / n, repeats]

    names = rule_ensemble.STATISTICS
    rows = rule_ensemble.with_statistics(hard_docs).select("_row.text", *names).collect()
    assert len(rows) == len(hard_rows)
    for row in rows:
        if row.text:
            assert [row[n] for n in names] == pytest.approx(plain(row.text)), row.text[:50]


def test_rules_come_from_tree_paths():
    text = "x\n  If (feature 0 <= 0.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 0 > 0.5)\n   Predict: 1.0\n"
    left = ("a", False, 0.5)
    assert rule_ensemble.rules_of(text, ["a", "b"]) == [
        (left,),
        (left, ("b", False, 2.0)),
        (left, ("b", True, 2.0)),
        (("a", True, 0.5),),
    ]


def test_token_store_round_trip(spark, hard_docs, hard_rows, no_docs):
    how = token_store.Store(public_tokenizers.path("word_bpe_49k.json"), block_tokens=500)
    folder = work_path(spark, "store")
    token_store.write_store(hard_docs, folder, how)
    rows = sorted(token_store.read_store(spark, folder).collect(), key=lambda r: r.start)
    at = 0
    for row in rows:
        assert row.start == at
        at += row.n_tokens
    ordered = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ordered == sorted(ordered)
    expected = Counter()
    for doc, text in hard_rows:
        ids = ids_of("word_bpe_49k.json", text)
        expected[doc, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    folder = work_path(spark, "store")
    token_store.write_store(no_docs, folder, how)
    assert token_store.read_store(spark, folder).count() == 0


@pytest.mark.parametrize("n, top", [(0, 0), (1, 0), (1, 7), (63, 5), (64, 10**9), (65, 65), (5000, 10**6)])
def test_elias_fano(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
    coded = token_store.EliasFano.from_bytes(token_store.EliasFano.of(values).to_bytes())
    assert coded.values().tolist() == values.tolist() == [coded.select(i) for i in range(n)]


def test_packing_is_whole_and_gapless(hard_docs, hard_rows, no_docs):
    how = packing.Packing(public_tokenizers.path("byte_bpe_50k.json"), length=128, open_bins=8)
    rows = packing.pack(hard_docs, how).collect()
    sequences, crcs = defaultdict(list), defaultdict(Counter)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        crcs[r.doc_id][r.piece, r.start, r.length, r.ids_crc32] += 1
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 128
    expected = defaultdict(Counter)
    for doc, text in hard_rows:
        ids = ids_of("byte_bpe_50k.json", text)
        first = len(ids) % 128 or 128
        edges = [0, *range(min(first, len(ids)), len(ids), 128), len(ids)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            expected[doc][k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert crcs == expected
    assert packing.pack(no_docs, how).count() == 0


def test_bins_take_the_tightest_and_close_the_fullest():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 7)] == [(0, 0), (1, 0)]
    assert bins.place(3) == (1, 7)  # fits both, fills the second
    assert bins.place(8) == (2, 0)
    assert bins.place(9) == (3, 0)  # two open: the one with 2 left closes
    assert bins.place(4) == (0, 6)
    assert bins.place(2) == (4, 0)  # the other one is closed for good


@pytest.mark.parametrize("shingle, percent", [(3, 90), (5, 80)])
def test_part_enum_equals_all_pairs(spark, shingle, percent):
    """Copies, a star of near copies around one text, chains, unrelated and tiny texts."""
    import random

    rng = random.Random(5)
    texts = {}
    for family in range(6):
        base = prose(family, [40, 60, 120, 150, 300, 12][family]).split()
        for k in range(25):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            if k % 7 == 0:
                words = words[: len(words) - rng.randrange(6)]
            texts[len(texts)] = " ".join(words)
    chain = prose(50, 200).split()
    for k in range(12):
        chain = list(chain)
        chain[k * 15] = f"step{k}"
        texts[len(texts)] = " ".join(chain)
    texts |= {500: None, 501: "", 502: "a", 503: "A", 504: "a b", 505: "a b c", 506: " "}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = part_enum.grouped(docs, part_enum.Join(shingle=shingle, percent=percent)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.groups(texts, shingle, percent)


def test_repeated_rows_lose_no_late_link(spark):
    """Texts around pivots that they do not link to, each row twelve times over."""
    import random

    rng = random.Random(9)
    texts = {}
    for family in range(8):
        base = prose(200 + family, 90).split()
        for _ in range(20):
            words = list(base)
            for _ in range(rng.choice([1, 1, 2, 2, 3])):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(words)
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
                texts[len(texts)] = " ".join(words)
    docs = spark.createDataFrame([row for row in texts.items() for _ in range(12)], "doc_id long, text string")
    rows = part_enum.grouped(docs, part_enum.Join(shingle=3, percent=90)).collect()
    assert len(rows) == 12 * len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.groups(texts, 3, 90)


@pytest.mark.parametrize("shingle, percent", [(3, 90), (5, 80), (2, 50)])
def test_sets_that_link_share_a_signature_and_a_first_feature(shingle, percent):
    how = part_enum.Join(shingle=shingle, percent=percent)
    rng = np.random.default_rng(percent)
    linked = 0
    for _ in range(4000):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 2**62, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[int(rng.integers(0, n // 3 + 1)) :], rng.integers(0, 2**62, int(rng.integers(0, 4))).astype(np.uint64)]))
        both, either = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        if both < either and 100 * both >= percent * either:
            linked += 1
            (sx, thin_x), (sy, thin_y) = part_enum.signatures(x, how), part_enum.signatures(y, how)
            assert (thin_x, thin_y) == (part_enum.is_thin(x, how), part_enum.is_thin(y, how))
            assert thin_x and thin_y or set(sx.tolist()) & set(sy.tolist())
            first, other = (dict(zip(np.sort(s).tolist(), part_enum.largest_partners(len(s), how).tolist())) for s in (x, y))
            assert any(other.get(f, 0) >= len(x) and most >= len(y) for f, most in first.items())
    assert linked > 500


@pytest.mark.parametrize("size, own", [(19, 1), (60, 6)])
def test_texts_of_one_template_are_not_compared_pair_by_pair(spark, monkeypatch, size, own):
    """Texts that differ from each other in a little more than a link allows: what is joined grows with the rows."""
    counts = {}
    plain = part_enum._stored

    def counted(df, name):
        found = plain(df, name)
        counts[name] = counts.get(name, 0) + found.count()
        return found

    monkeypatch.setattr(part_enum, "_stored", counted)
    base = prose(77, size).split()
    texts = {i: " ".join(base[:-own] + [f"own{i}x{k}" for k in range(own)]) for i in range(2000)}
    texts[5000], texts[5001] = texts[7] + " more", texts[9]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in part_enum.grouped(docs, part_enum.Join(shingle=3, percent=90)).collect()}
    assert found == {i: {5000: 7, 5001: 9}.get(i, i) for i in texts}
    assert counts.get("part-enum-meetings", 0) < 4000 and counts["part-enum-close"] < 60_000, counts


def test_texts_without_id_meet_their_own_class_only(spark):
    rows = [(None, prose(400 + i, 30)) for i in range(50)] + [(1, prose(500 + i, 30)) for i in range(50)]
    docs, how = spark.createDataFrame(rows, "doc_id long, text string"), part_enum.Join()
    sets = part_enum._sets(docs, how)
    found = sets.join(part_enum._classes(sets).checkpoint().select("number", "cid"), "number").collect()
    assert len(found) == 100 and len({(r.text1, r.text2, r.cid) for r in found}) == 100


def test_part_enum_edges(hard_docs, hard_rows, no_docs):
    how = part_enum.Join(shingle=3, percent=90)
    rows = part_enum.grouped(hard_docs, how).collect()
    assert len(rows) == len(hard_rows)
    found = {r.doc_id: r.component_id for r in rows}
    assert (found[2], found[3], found[9], found[6], found[None]) == (1, 1, 8, 6, None)
    assert part_enum.grouped(no_docs, how).count() == 0
    kept = part_enum.one_of_each(hard_docs, how)
    assert kept.columns == hard_docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert {2, 3, 9}.isdisjoint(ids) and ids[16] == 1 and ids[None] == 1 and {4, 5, 6} <= set(ids)


def test_rows_go_by_their_own_text(spark):
    """A null or shared ``doc_id`` does not take other texts along."""
    a, b, c, d, e = (prose(s, 120) for s in (70, 71, 72, 73, 74))
    near = lambda text: text + " more"
    rows = [(1, a), (None, near(a)), (None, b), (5, c), (5, near(near(a))), (None, d), (None, near(d)), (7, e), (7, near(e))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in part_enum.one_of_each(docs).collect()]
    assert len(kept) == 5 and {(1, a), (None, b), (5, c)} <= set(kept)
    assert len({(None, d), (None, near(d))} & set(kept)) == len({(7, e), (7, near(e))} & set(kept)) == 1
    item = " ".join(d.split()[20:40])
    items = spark.createDataFrame([(1, item), (2, " ".join(c.split()[20:40]))], "item_id long, text string")
    clean = {tuple(r) for r in decontamination.clean(docs, items).collect()}
    assert clean == set(rows) - {(None, d), (None, near(d)), (5, c)}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_containment_equals_brute_force(spark, hard_docs, hard_rows, no_docs):

    long = dict(hard_rows)[10].split(" ")
    items = {1: " ".join(long[5000:5040]), 2: prose(999, 40), 3: None, 4: "", 5: "one two", 6: "one"}
    items[7] = " ".join([*long[100:130], "other", "words", "here"])
    table = spark.createDataFrame(list(items.items()), "item_id long, text string").withColumn("doc_id", F.lit(1))
    wanted = {}
    for doc, text in hard_rows:
        held = brute.shingles(text, 5, brute.PLAIN_WORD)
        for item, words in items.items():
            parts = brute.shingles(words, 5, brute.PLAIN_WORD)
            if parts and 100 * len(parts & held) >= 80 * len(parts):
                wanted[doc, item] = len(parts & held)
    for rows in (10**6, 0):  # broadcast, and Spark's own choice
        how = decontamination.Containment(broadcast_rows=rows)
        found = decontamination.contaminations(hard_docs, table, how).collect()
        assert {(r.doc_id, r.item_id): r.n_found for r in found} == wanted
    assert (10, 1) in wanted and (7, 6) in wanted
    kept = decontamination.clean(hard_docs, table)
    dirty = {doc for doc, _ in wanted}
    assert kept.columns == hard_docs.columns
    assert kept.count() == sum(doc not in dirty for doc, _ in hard_rows)
    assert decontamination.contaminations(no_docs, table).count() == 0
    assert decontamination.contaminations(hard_docs, table.limit(0)).count() == 0


def test_texts_and_items_that_share_an_id_are_not_put_together(spark):
    item, other = prose(900, 40).split(" "), prose(901, 40).split(" ")
    halves = [(None, " ".join(item[:22])), (None, " ".join(item[18:])), (5, " ".join(item[:22])), (5, " ".join(item[18:]))]
    whole = [(5, prose(902, 50) + " " + " ".join(item)), (None, " ".join(item)), (None, " ".join(item)), (6, " ".join(other))]
    docs = spark.createDataFrame(halves + whole, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(other)), (1, " ".join(other))], "item_id long, text string")
    found = decontamination.contaminations(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.containment) for r in found) == [(0, 1, 1.0), (5, 1, 1.0), (6, 1, 1.0)]
    assert Counter(map(tuple, decontamination.clean(docs, items).collect())) == Counter(halves)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_sketches_miss_no_item(spark, percent):
    how = decontamination.Containment(percent=percent)
    items = {n: prose(1000 + n, n) for n in (5, 6, 9, 13, 20, 36, 70, 140, 300)}
    docs = {}
    for n, text in items.items():
        listed = text.split(" ")
        for lost in range(0, 12):
            cut = int(len(listed) * (100 - percent) / 100) + lost - 6
            if 0 <= cut < len(listed):
                docs[len(docs)] = " ".join([prose(len(docs), 30), *listed[cut:], prose(len(docs) + 500, 30)])
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontamination.contaminations(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), table, how)
    wanted = set()
    for doc, text in docs.items():
        for item, words in items.items():
            parts = brute.shingles(words, 5, brute.PLAIN_WORD)
            if 100 * len(parts & brute.shingles(text, 5, brute.PLAIN_WORD)) >= percent * len(parts):
                wanted.add((doc, item))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == wanted and len(wanted) > 10
    sizes = decontamination.index(table, how).groupBy("item_id").agg(
        F.max("size_part").alias("part"), F.max("need_sketched").alias("need"), F.sum(F.col("sketched").cast("int")).alias("n"), F.max("n_item").alias("of")
    ).collect()
    assert all(r.part == r["of"].bit_length() and 1 <= r.need <= r.n <= r["of"] for r in sizes)
    assert percent == 50 or any(r.n < r["of"] for r in sizes)


def test_licence_places_equal_brute_force(spark, hard_docs, hard_rows, no_docs):
    rows = license_scan.scan(hard_docs).collect()
    found = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
    assert found == Counter((i, *brute.licence_places(t)) for i, t in hard_rows)
    assert {r.doc_id: r.labels for r in rows}[14] == "apache,mit"
    assert license_scan.scan(no_docs).count() == 0


def test_licence_labels_equal_plain_search(spark):
    """Every place of every template, tried one by one."""
    rng = np.random.default_rng(3)
    notices = [license_scan._split(t.notice) for t in license_scan.TEMPLATES]
    texts = {}
    for i in range(120):
        listed = prose(i, 20).split(" ")
        for k in rng.integers(0, len(notices), 2):
            part = list(notices[k][rng.integers(0, 3) :])
            if rng.random() < 0.5:
                part[rng.integers(0, len(part))] = "changed"
            at = rng.integers(0, len(listed) + 1)
            listed[at:at] = part
        texts[i] = " ".join(listed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    how = license_scan.Scan()
    index = license_scan._index(how, license_scan.weights(docs, how))
    for row in license_scan.scan(docs, how).collect():
        listed = license_scan._split(texts[row.doc_id])
        at = lambda i: listed[i] if 0 <= i < len(listed) else None
        labels, best = set(filter(None, brute.licence_places(texts[row.doc_id])[4].split(","))), 0.0
        for template in index:
            for start in range(-40, len(listed)):
                share = sum(x for w, i, x in template["places"] if at(start + i) == w)
                phrases = all(all(at(start + i + k) == w for k, w in enumerate(p)) for i, p in template["phrases"])
                if share >= how.share and phrases:
                    labels.add(template["label"])
                    best = max(best, min(share, 1.0))
        assert row.labels == ",".join(sorted(labels)) and row.score == pytest.approx(best)


def test_a_text_of_licence_words_takes_linear_time(spark):
    text = "license apache mit public general version 2 the cc by " * 6400
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.monotonic()
    assert license_scan.scan(docs).first().n_words == 64_000
    assert time.monotonic() - start < 20


def test_licence_templates(spark):
    texts = {
        1: "Licensed under CC BY-NC 4.0.",
        2: "this is not licensed under anything by anyone",
        3: "License\nThis Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        4: "mit license license mit license",
        5: "cc by nc",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert [rows[i].labels for i in range(1, 6)][:4] == ["cc-by-nc", "", "mpl", "mit"]
    assert rows[4].n_base == 2 and (rows[4].first_word, rows[4].last_word) == (0, 3)
    assert rows[1].score == pytest.approx(1.0) and rows[2].score == 0.0


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    model = language_id.fit(docs.where(~language_id.held_out()))
    rows = language_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(language_id.held_out()).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_language_spans_and_edges(spark, hard_docs, hard_rows, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    texts = {lang: " ".join(r.text.replace("\n", " ").split()[:60]) for lang in ("en", "de") for r in docs.where(f"lang = '{lang}' and n_chars > 1500").orderBy("doc_id").limit(1).collect()}
    mixed = spark.createDataFrame([(1, texts["en"] + " " + texts["de"])], "doc_id long, text string")
    spans = language_id.predict(mixed, model).first().spans
    assert [s["lang"] for s in spans] == ["en", "de"] and spans[0]["start"] == 0
    rows = language_id.predict(hard_docs, model).collect()
    assert len(rows) == len(hard_rows)
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 and not by_id[i].spans for i in (4, 5, 6, 12))
    assert all(r.lang_pred in (*model.languages, "und") and 0 <= r.score <= 1 for r in rows)
    assert language_id.predict(no_docs, model).count() == 0
    nothing = language_id.fit(hard_docs.where("lang = 'xx'"))
    assert {r.lang_pred for r in language_id.predict(hard_docs, nothing).collect()} == {"und"}


def test_numerals_are_no_letters(spark):
    texts = ["½", "²", "①", "Ⅷ", "12 34", "_", "٣", "a½b", None, "½ word"]
    known = spark.createDataFrame([(1, "some words to learn from", "en")], "doc_id long, text string, lang string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, len(r.spans)) for r in language_id.predict(docs, language_id.fit(known)).collect()}
    assert [found[i][0] for i in range(len(texts))] == ["und"] * 7 + ["en", "und", "en"]
    assert language_id.words_of("a½b été ⅷx") == ["a", "b", "été", "x"]


def test_every_language_is_learned(spark):
    """More languages than fit a byte, one of them with most rows, at a small bound of rows."""
    import random

    def text(lang, i):
        rng = random.Random(lang)
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)]
        return " ".join(random.Random(i).choices(words, k=20))

    rows = [(i, text(0, i), "l0") for i in range(3000)]
    rows += [(10_000 + 10 * k + i, text(k, i), f"l{k}") for k in range(1, 140) for i in range(4)]
    rows += [(None, text(140, i), "l140") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, language_id.Fit(max_rows=200, min_rows=3))
    assert set(model.languages) == {f"l{k}" for k in range(141)}
    few = docs.where("doc_id >= 10000 or doc_id < 50 or doc_id is null")
    counted = Counter((r.lang, r.lang_pred) for r in language_id.predict(few, model).join(few.select("doc_id", "lang"), "doc_id").collect())
    assert sum(n for (a, b), n in counted.items() if a == b) >= 0.97 * sum(counted.values())
    assert language_id._quota([10, 100, 1000], language_id.Fit(max_rows=300, min_rows=5)) == 190
    assert language_id._quota([10, 100], language_id.Fit(max_rows=300, min_rows=5)) == 100


def test_viterbi_equals_all_paths():
    import itertools

    model = language_id.Model(["a", "b", "c"], np.zeros((language_id.BUCKETS, 3), np.float32), np.ones((15, 3), bool), 2.0)
    labeller = language_id.Labeller(model)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(6)]
    labeller.place = {w: i for i, w in enumerate(words)}
    labeller.rows = rng.normal(0, 2, (6, 3)).astype(np.float32)

    def value(text, path):
        return sum(labeller.rows[labeller.place[w], k] for w, k in zip(text, path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

    texts = [list(rng.choice(words, n)) for n in (1, 5, 3, 0, 6)]
    for text, path in zip(texts, labeller.label(texts)):
        if text:
            best = max(value(text, p) for p in itertools.product(range(3), repeat=len(text)))
            assert value(text, path.tolist()) == pytest.approx(best, abs=1e-4)


PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=1>Menu</a></nav>"
    "<div class=ad>Buy this, now, please, it is a long advert text.</div><article><h1>Title &amp; more</h1>"
    "<p>First paragraph,   with\ncommas, and <b>bold</b> words that go on.<p>Second <a href=x>linked</a> paragraph, which is long enough.<br>"
    "<ul><li>one<li>two</ul><script>var x = '<p>no</p>';</script></article>"
    "<div id=comments><p>A reader wrote a comment, a long one, with commas, too.</p></div><footer>&copy; site</footer></body></html>"
)


def test_main_text():
    assert html_text.main_text(PAGE) == (
        "Title & more\nFirst paragraph, with commas, and bold words that go on.\n"
        "Second linked paragraph, which is long enough.\none\ntwo"
    )
    plain = "<body><div class=menu><a href=1>x</a></div><div><p>Some text, long enough to count here.</p><p>More text, long enough to count here.</p></div>"
    assert html_text.main_text(plain) == "Some text, long enough to count here.\nMore text, long enough to count here."
    for broken in ("", "<", "<p", "<p class='x", "</div></div>", "<!-- open", "<script>", "a < b", "<div>" * 5000):
        assert isinstance(html_text.main_text(broken), str)
    assert html_text.main_text("a < b &lt; c") == "a < b < c"


LONG = "<p>A paragraph of prose that is long enough to count, with commas, and with a number {}.</p>"


@pytest.mark.parametrize("marks", [("", ""), (" id=one", " id=two"), (" class=x", "")])
def test_siblings_are_kept_whatever_their_marks(marks):
    first, second = ("".join(LONG.format(i) for i in ids) for ids in (range(3), range(3, 5)))
    page = f"<body><div class=ad>Buy this, now.</div><div{marks[0]}>{first}</div><div{marks[1]}>{second}</div></body>"
    lines = html_text.main_text(page).split("\n")
    assert lines == [LONG.format(i)[3:-4] for i in range(5)]


@pytest.mark.parametrize("opened", ["div class='has-sidebar'", "div class='page no-comments with-nav'", "form", "div class=sidebar", "aside"])
def test_wrappers_of_the_page_are_read(opened):
    page = (
        f"<body><{opened}><nav><a href=1>Menu</a></nav><div class=text>{''.join(LONG.format(i) for i in range(4))}</div>"
        f"<div class=comments>{LONG.format(9)}</div></{opened.split()[0]}></body>"
    )
    assert html_text.main_text(page).split("\n") == [LONG.format(i)[3:-4] for i in range(4)]


@pytest.mark.parametrize(
    "mark",
    "comment-list reader-comments site-footer cookie-notice ad-slot sidebar-left related-posts main_nav siteFooter "
    "share-buttons newsletter-signup page-header post-footer article-comments breadcrumb-trail top-banner ad".split(),
)
def test_names_of_what_is_not_the_article(mark):
    article = "".join(LONG.format(i) for i in range(5))
    lines = [LONG.format(i)[3:-4] for i in range(5)]
    extra = f"<div class='x {mark}'>{LONG.format(9)}</div>"
    assert html_text.main_text(f"<body><div>{article}</div>{extra}</body>").split("\n") == lines
    assert html_text.main_text(f"<body><article>{article}{extra}</article></body>").split("\n") == lines


@pytest.mark.parametrize("mark", "no-comments has-sidebar with_ads advice header-free-post entry-header article__header content-wide roads".split())
def test_names_that_only_look_like_it(mark):
    page = f"<article><div class={mark}>{LONG.format(0)}</div>{LONG.format(1)}{LONG.format(2)}</article>"
    assert html_text.main_text(page).count("\n") == 2


def test_raw_elements_end_in_any_case():
    page = "<body><p>\u0130 " + LONG[3:] + "<SCRIPT>var a = '<p>no</p></scripted>';</Script >" + LONG.format(1) + "<style>p{}</STYLE>" + LONG.format(2)
    text = html_text.main_text(page)
    assert "no" not in text.split() and text.count("\n") == 2 and "number 2" in text


def test_deep_pages_take_linear_time():
    def seconds(n):
        pages = ["<div>" + LONG.format(1), "<b>", "</x><li></div>" + LONG.format(2), "<span><p>x</p>"]
        start = time.process_time()
        for part in pages:
            html_text.main_text("<b>" * n + part * n)
        return time.process_time() - start

    assert seconds(20_000) < 16 * max(seconds(2_500), 0.05)


def test_extract_edges(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "u", "<p>x" + "y" * 10**6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    found = html_text.extract(pages).collect()
    assert Counter(r.page_id for r in found) == Counter(r[0] for r in rows)
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_audit_finds_each_damage(spark):
    rows = [(i, f"record {i} " + "x" * (i % 50)) for i in range(5000)] + [(7, "record 7 again"), (None, "a"), (None, "b"), (8, None)]
    original = spark.createDataFrame(rows, "record_id long, record string")
    how = fixity.Tree(leaf_bytes=512, fanout=4, levels=6, file_records=1000)
    assert fixity.audited(original, original, how).count() == 0
    damaged = [(i, (r + "!") if i == 123 else r) for i, r in rows if i != 4500 and r != "b"] + [(9000, "new")]
    replica = spark.createDataFrame(damaged, "record_id long, record string")
    found = {(r.record_id, r.status) for r in fixity.audited(original, replica, how).collect()}
    assert found == {(123, "corrupt"), (4500, "missing"), (None, "missing"), (None, "extra")}
    none = original.limit(0)
    assert fixity.audited(none, none, how).count() == 0
    assert fixity.audited(original.limit(3), none, how).count() == 3


def test_audit_descends_only_where_hashes_differ(spark):
    """With one file damaged, the nodes compared below the roots are that file's."""
    rows = spark.range(4000).selectExpr("id as record_id", "concat('r', id) as record")
    how = fixity.Tree(leaf_bytes=256, fanout=4, levels=5, file_records=1000)
    other = rows.withColumn("record", F.when(F.col("record_id") == 2500, "bad").otherwise(F.col("record")))
    found = fixity.audited(rows, other, how).collect()
    assert [(r.record_id, r.file, r.status) for r in found] == [(2500, 2, "corrupt")]
