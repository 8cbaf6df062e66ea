"""BPE, shards, Jaccard join, suffix dedup, language and toxicity on small tables with edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from helixmart.llm import bpe, common, decontaminate, jaccard, langid, sharding, suffixes, toxicity
from helixmart.llm.queries import word_bpe_file

DOCS = "doc_id long, text string, lang string, source string, label int"


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus(seed=3):
    """Copies, near copies, shared passages, NULLs, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    rows = []
    for i in range(40):
        text = words(rng, rng.choice([1, 2, 5, 80, 300]))
        if i % 5 == 0:
            text = f"{text} {passage} {words(rng, 7)}"
        rows.append((i, text))
    base = words(rng, 200)
    for i in range(40, 60):  # near copies of one text
        w = base.split()
        for _ in range(i % 6):
            w[rng.randrange(len(w))] = words(rng, 1)
        rows.append((i, " ".join(w)))
    rows += [(60, rows[3][1]), (61, rows[3][1]), (62, None), (63, ""), (64, " \t\n"), (65, "Ünï códe " * 30), (66, words(rng, 20_000)), (5, rows[5][1])]
    return [(i, t, "en", "s", 7) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---- BPE ---------------------------------------------------------------------------------------------------------


def test_bpe_is_the_library(spark):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    library = Tokenizer.from_file(word_bpe_file())
    odd = "aeiou tnsrlABCΣΐéè'!!<|>ſﬁ1234²½ \n\x1c\x85\xa0一二가각🙂İIẞß"
    texts = ["", None, "   ", "ΑΣ ΟΔΟΣ", "it's <|endoftext|>we're<|startoftext|>x", "xxxxxxxxxx aaaaaaaaa", "é Å"]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts.append(words(rng, 30_000, "abcdefghijklmnopqrstuvwxyz"))
    df = spark.createDataFrame([(i, t, "ids") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    coded = bpe.decode(bpe.encode(df, word_bpe_file(), keep=["kept"]), word_bpe_file())
    for row in coded.collect():
        want = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == want
        assert row["decoded"] == library.decode(want, skip_special_tokens=False)
        assert row["kept"] == "ids"
    at_once = bpe.round_trip(df, word_bpe_file(), keep=["kept"])
    assert at_once.schema == coded.schema
    assert sorted(at_once.collect()) == sorted(coded.collect())


def test_bpe_of_no_rows(spark):
    assert bpe.decode(bpe.encode(empty(spark), word_bpe_file()), word_bpe_file()).collect() == []
    assert bpe.round_trip(empty(spark), word_bpe_file()).collect() == []


def test_every_token_spells_itself():
    vocab = bpe.vocabulary(word_bpe_file())
    assert all(vocab.word(vocab._spell(t)) == [i] for t, i in vocab.ids.items())


# ---- shards ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shards", [3, 7])
def test_shards(spark, docs, shards):
    hot = spark.createDataFrame([(1000 + i, "same", None, None, None) for i in range(50)], DOCS)
    rows = sharding.shard(docs.union(hot), shards=shards).collect()
    total = docs.count() + 50
    assert len(rows) == total
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(shards))
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    texts = dict((i, t) for i, t, *_ in corpus())
    for r in rows:
        if r["doc_id"] < 1000:
            raw = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    homes = {r["shard"] for r in rows if r["doc_id"] in (3, 60, 61)}
    assert len(homes) == 1  # equal texts stand together
    assert len({r["shard"] for r in rows if r["doc_id"] >= 1000}) <= -(-50 // (total // shards)) + 2


def test_shards_of_no_rows(spark):
    assert sharding.shard(empty(spark)).collect() == []


# ---- Jaccard join ------------------------------------------------------------------------------------------------


def components_by_force(rows, k, percent):
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, row in enumerate(rows):
        least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted((row[0], len(sets[i]), least[find(i)]) for i, row in enumerate(rows))


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_components(spark, docs, k, percent):
    got = sorted(map(tuple, jaccard.jaccard_components(docs, k, percent).collect()))
    assert got == components_by_force(corpus(), k, percent)


def test_jaccard_chain_and_unlinked_family(spark):
    rng = random.Random(9)
    base = words(rng, 150).split()
    rows = []
    for i in range(60):  # a chain: each text differs from the next in two words, from others in more
        w = list(base)
        w[: 2 * i] = [f"e{j}" for j in range(2 * i)]
        rows.append((i, " ".join(w)))
    for i in range(60, 140):  # a family around one text, most members too far from each other
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(150)] = words(rng, 1)
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(map(tuple, jaccard.jaccard_components(df).collect())) == components_by_force(rows, 3, 90)


def test_jaccard_inside_large_regions(spark, monkeypatch):
    """All regions count as large: joined by differences from their pivots, with inner regions."""
    monkeypatch.setattr(jaccard, "SMALL", 1)
    rng = random.Random(21)
    base = words(rng, 120).split()
    rows = [(i, words(rng, 100)) for i in range(10)]
    for i in range(10, 90):  # pairwise mostly unlinked, around a text that is not there
        w = list(base)
        for j in rng.sample(range(120), rng.randint(1, 5)):
            w[j] = words(rng, 1)
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, jaccard.jaccard_components(df, 5, 80).collect())) == components_by_force(rows, 5, 80)


def test_jaccard_measures_few_pairs_of_unlinked_texts(spark, monkeypatch):
    seen = []
    joined = jaccard.Sets._joined
    monkeypatch.setattr(jaccard.Sets, "_joined", lambda self, pairs: seen.append(pairs.count()) or joined(self, pairs))
    rng = random.Random(8)
    passages = [words(rng, 60) for _ in range(3)]
    rows = [(i, f"{words(rng, 150)} {passages[i % 3]} {words(rng, 150)}") for i in range(240)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert all(r["component_id"] == r["doc_id"] for r in got.collect())
    assert sum(seen) <= 5 * len(rows)


def test_jaccard_bounds():
    rng = random.Random(6)
    for _ in range(300):
        percent, n = rng.choice([50, 80, 90]), rng.randint(1, 60)
        x = {rng.randrange(2**62) for _ in range(n)}
        y = set(rng.sample(sorted(x), rng.randint(0, len(x)))) | {rng.randrange(2**62) for _ in range(rng.randint(0, 8))}
        if not y:
            continue
        a, b = (np.array(sorted(s), dtype=np.uint64) for s in (x, y))
        assert jaccard.least_apart(jaccard.parity(a), jaccard.parity(b)) <= len(x ^ y)
        if 100 * len(x & y) >= percent * len(x | y):
            assert len(x ^ y) <= jaccard.most_apart(len(x), len(y), percent)
            order = sorted(x | y, key=lambda v: v % 1000)
            small, large = sorted((x, y), key=len)
            first = [v for v in order if v in small][: jaccard.prefixes(len(small), percent)[0]]
            later = [v for v in order if v in large][: jaccard.prefixes(len(large), percent)[1]]
            assert set(first) & set(later)


def test_jaccard_of_no_rows(spark):
    assert jaccard.jaccard_components(empty(spark)).collect() == []


def test_components_of_chains(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(i, i + 1) for i in range(400, 420)] + [(7, 7), (1, 0)]
    rng.shuffle(edges)
    roots = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {roots[i] for i in range(301)} == {0} and {roots[i] for i in range(400, 421)} == {400}


def test_jaccard_components_pass_small_batches_to_python(spark, monkeypatch):
    name, seen, edges = "spark.sql.execution.arrow.maxRecordsPerBatch", [], jaccard._edges
    before = spark.conf.get(name)
    monkeypatch.setattr(jaccard, "_edges", lambda *a: seen.append(int(spark.conf.get(name))) or edges(*a))
    rows = [(i, f"a b c d e f g h i j k {i % 7}") for i in range(30)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 7 for i in range(30)}
    assert max(seen) <= jaccard.BATCH < int(before) and spark.conf.get(name) == before


# ---- suffix dedup ------------------------------------------------------------------------------------------------


def dedup_by_force(rows, width=100):
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - width + 1):
            key = raw[p : p + width]
            first[key] = min(first.get(key, (i, p)), (i, p))
    out = []
    for i, text in rows:
        raw, gone = (text or "").encode(), set()
        for p in range(len(raw) - width + 1):
            if first[raw[p : p + width]] < (i, p):
                gone.update(range(p, p + width))
        spans = sum(1 for p in gone if p - 1 not in gone)
        kept = bytes(b for p, b in enumerate(raw) if p not in gone)
        out.append((i, len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup(spark, docs):
    rows = [r[:2] for r in corpus()]
    rng = random.Random(4)
    shared = [words(rng, 40) for _ in range(3)]
    for i in range(100, 140):  # the same passages between different neighbours, at odd offsets; runs of one byte
        rows.append((i, words(rng, rng.randint(0, 9)) + rng.choice(shared)[rng.randint(0, 60) :] + words(rng, 8) + rng.choice(shared)))
    rows += [(200, "a" * 350), (201, "b" * 99 + "a" * 120), (202, "ab" * 200), (203, "é" * 140), (150, rows[-1][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string").repartition(6)
    done = suffixes.dedup(df).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in done)
    assert got == dedup_by_force(rows)


def test_suffixes_are_sorted_only_where_83_bytes_repeat(spark):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    prose = lambda n: "".join(rng.choice(letters) for _ in range(n))
    short, long = [prose(79) for _ in range(8)], prose(130)
    # 79 bytes, and those beside them that chance makes equal, are too few for any region; 130 hold 31 windows of 100 bytes.
    texts = {i: prose(150) + short[i % 8] + prose(150) for i in range(40)} | {100 + i: prose(150) + long + prose(150) for i in range(40)}
    keyed = spark.createDataFrame([(0, i, t.encode()) for i, t in texts.items()], "tag long, id long, text binary").repartition(3)
    opened = {}
    for r in suffixes._placed(keyed).where("open").collect():
        opened.setdefault(r["id"], set()).update(range(r["first"], r["first"] + r["more"] + 1))
    assert all(set(range(150, 181)) <= opened[100 + i] for i in range(40))
    assert not any(i in opened for i in range(40))
    rows = sorted(texts.items())
    done = suffixes.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in done)
    assert got == dedup_by_force(rows)


def test_suffix_dedup_of_null_ids_and_no_rows(spark):
    text = "0123456789" * 3 + "the only text of this small table, which is longer than a hundred bytes, so that a copy is seen" * 2
    df = spark.createDataFrame([(None, text), (4, text)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] > 0 for r in suffixes.dedup(df).collect()}[None]
    assert suffixes.dedup(empty(spark)).collect() == []


def test_loser_tree():
    rng = random.Random(6)
    runs = []
    for _ in range(11):
        keys = sorted(("".join(rng.choice("ab") for _ in range(100))[: rng.randint(1, 100)].ljust(100, "a")).encode() + bytes(15) + bytes([rng.randrange(9)]) for _ in range(rng.randint(0, 60)))
        runs.append(keys)
    coded = [suffixes.read_blocks([suffixes.write_block(r[i : i + 7]) for i in range(0, len(r), 7)]) for r in runs]
    merged = list(suffixes.LoserTree(coded))
    assert [e for _, e in merged] == sorted(e for r in runs for e in r)
    assert [n for n, _ in merged][1:] == suffixes.front_code([e[:100] for _, e in merged])[1:]


# ---- language ----------------------------------------------------------------------------------------------------

PROSE = {"aa": "tion ing the and er ly of in", "bb": "ung sch keit der ein ver", "cc": "ción mente que los ar"}


def prose(rng, lang, n):
    parts = PROSE[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, lang, rng.choice([4, 30, 2000])), lang) for i in range(150) for lang in [rng.choice(sorted(PROSE))]]
    extra = [(200, None, "aa"), (201, "", None), (202, "12 34!", "bb"), (203, "漢字", None), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").withColumn("score", common.F.lit("clash"))
    got = langid.identify_held_out(df).collect()
    assert len(got) == 155
    right = [r["lang_pred"] == rows[r["doc_id"]][2] for r in got if r["doc_id"] < 150]
    assert sum(right) >= 0.98 * len(right)
    by_id = {r["doc_id"]: r for r in got}
    assert {by_id[i]["lang_pred"] for i in (200, 201, 202)} == {"und"} and by_id[203]["lang_pred"] in PROSE
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "word", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.identify_held_out(df).collect()] == ["und"]
    assert langid.identify_held_out(empty(spark)).collect() == []


def test_suffix_automaton_accepts_substrings_only():
    rng = random.Random(8)
    s = [rng.randrange(3) for _ in range(60)]
    moves = langid.suffix_automaton(s)
    found = {tuple(s[i:j]) for i in range(60) for j in range(i, 61)}
    for _ in range(400):
        probe, state = [rng.randrange(3) for _ in range(rng.randint(1, 7))], 0
        for c in probe:
            state = moves[state].get(c) if state is not None else None
        assert (state is not None) == (tuple(probe) in found)


def test_phrases_are_longest_matches():
    model = langid.Model((("x", "abcabdab"), ("y", "zzz")))
    text = "abdabcqab cab"
    sample, count, at = "abcabdab", 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        count, at = count + 1, at + n
    assert model.phrases([text])[0][0][0] == count


# ---- toxicity ----------------------------------------------------------------------------------------------------


def toxic_corpus(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        w = words(rng, 40).split()
        if bad:
            for _ in range(3):
                w[rng.randrange(40)] = rng.choice(["vexil", "grumph", "snarkle"])
        rows.append((i, " ".join(w), "en"))
        if i % 3 == 0:
            labels.append((i, 0, int(bad)))
    rows += [(700, None, None), (701, "", None), (0, rows[0][1], None)]
    labels += [(3, 1, None), (9999, 1, 1), (6, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = toxic_corpus(spark)
    got = toxicity.score_held_out(docs, labels).collect()
    assert len(got) == 603
    right = [r["predicted"] == int(r["doc_id"] % 6 == 0) for r in got if r["doc_id"] < 600]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert {r["predicted"] for r in got if r["doc_id"] >= 700} == {0}
    seen = next(r for r in got if r["predicted"] == 1)
    assert seen["neighbours"] and len(seen["neighbours"]) == len(seen["cosines"]) and all(i % 3 == 0 for i in seen["neighbours"])


def test_toxicity_without_labels(spark):
    docs, labels = toxic_corpus(spark)
    assert {r["score"] for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_held_out(empty(spark), labels).collect() == []


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    dense = np.where(rng.random((400, 30)) < 0.15, rng.random((400, 30)), 0)
    vectors = [(np.flatnonzero(r), r[r > 0]) for r in dense]
    index = toxicity.Index(np.ones(31), vectors, np.zeros(400), list(range(400)))
    for q in np.where(rng.random((50, 30)) < 0.2, rng.random((50, 30)), 0):
        terms = np.flatnonzero(q)
        rows, scores = index.nearest(terms, q[terms], 7)
        want = dense @ q
        best = np.lexsort((np.arange(400), -want))[:7]
        best = best[want[best] > 0]
        assert np.allclose(scores, want[best]) and set(rows) == set(best)


# ---- decontamination ---------------------------------------------------------------------------------------------

ITEM = "A farmer near Dunwich has 14 kg of apples and gives 3 kg to Ingrid while Ingrid sells 3 kg of them for 12 dollars at the market"


def test_decontamination(spark):
    other = ITEM.replace("14", "25").replace("3 kg", "7 kg").replace("kg", "lb").replace("Ingrid", "Olaf").replace("12", "31").replace("Dunwich", "Bergen")
    mixed = ITEM.replace("14", "25").replace("3 kg to Ingrid", "8 kg to Olaf").replace("Ingrid sells 3", "Pedro sells 9")
    rng = random.Random(3)
    texts = {
        1: f"{words(rng, 50)}. {ITEM}. {words(rng, 50)}", 2: f"{words(rng, 9)} {other}, {words(rng, 9)}", 3: f"{words(rng, 20)}. {mixed}. {words(rng, 9)}",
        4: words(rng, 300), 5: None, 6: "", 7: " ".join(ITEM.split()[:6]), 8: "12 34 56 78 90 12 34 56 78 90", 9: ITEM.replace(" ", "\n "),
    }
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in texts.items()] + [(1, texts[1], 0, "x")], "doc_id long, text string, item_id int, canon string")
    items = spark.createDataFrame([(0, ITEM, 5), (1, None, 5), (2, "too short", 5), (3, "six words make up this one", 5), (4, "1 2 3 4 5 6 7 8 9", 5)], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 0): "verbatim", (2, 0): "reparameterised", (9, 0): "verbatim"}
    left = decontaminate.decontaminate(docs, items)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6, 7, 8] and left.columns == docs.columns
    assert decontaminate.contaminated(docs, items.limit(0)).collect() == []
    assert decontaminate.contaminated(docs.limit(0), items).collect() == []


def test_short_items_match_as_a_whole(spark):
    docs = spark.createDataFrame([(1, "so six words make up this one here"), (2, "six words make up this two")], "doc_id long, text string")
    items = spark.createDataFrame([(3, "Six words make up this one.")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()] == [(1, 3)]


def contaminated_pairs(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    return {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_verbatim_items_of_any_make(spark):
    rng = random.Random(5)
    items = ["小明有十二个苹果，他给了小红三个，还剩几个？", "ประเทศไทยมีกี่จังหวัด", "Who wrote Hamlet?", "Compute 12 + 34 * 56 - 78 / 9 + 10", "The Great Fire Of London Began In Pudding Lane In 1666", "!!"]
    texts = [f"{words(rng, 20)} {t} {words(rng, 20)}" for t in items[:5]]
    texts += ["小红有十二本书", "who wrote it", "Compute 13 + 35 * 57 - 79 / 8 + 11", "The Small House Of Berlin Stood In Garden Street In 1777", "Compute 12 - 34 * 56 + 78 / 9 - 10"]
    assert contaminated_pairs(spark, texts, items) == {(i, i) for i in range(5)}


def test_conflicting_slots_take_only_their_windows(spark):
    rng = random.Random(8)
    lead, tail = words(rng, 20), words(rng, 20)
    items = [f"{lead} 17 {tail} 17 {words(rng, 3)}", f"so 3 {words(rng, 20)} and {words(rng, 20)} for 3"]
    texts = [items[0].replace("17", "18", 1), items[1].replace("so 3", "so 8").replace("for 3", "for 9"), f"so 8 {words(rng, 30)} for 9"]
    assert contaminated_pairs(spark, texts, items) == {(0, 0), (1, 1)}
    # No six windows of equal words: the places of 3 that conflict are at the ends only.
    part = "so 3 boys and 5 girls who each walk to 5 or more shops buy bread there and then eat 3"
    text = part.replace("5", "6").replace("so 3", "so 8").replace("eat 3", "eat 9")
    assert contaminated_pairs(spark, [text], [part]) == {(0, 0)}


def test_slots_of_other_lengths_and_at_sentence_starts(spark):
    items = [
        "the train from New York takes 5 km of track and then waits for the old bridge to open",
        "Tom has 5 apples. Tom buys 3 more at the shop. Tom eats some of them. Tom sells what is left",
        "How many are 5 and 7",
    ]
    texts = [
        items[0].replace("New York", "Paris").replace("5 km", "7km"),
        items[1].replace("Tom", "Mary Ann").replace("5", "8").replace("3", "9"),
        items[2].replace("5", "6").replace("7", "9"),
        "so how many are 61 and 9 then",
        "Sam are 5 and 7 then",
    ]
    assert contaminated_pairs(spark, texts, items) == {(0, 0), (1, 1), (2, 2), (3, 2)}
