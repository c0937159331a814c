"""Odd rows (nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables) and brute force on small tables."""

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F, types as T

from terrace.llm import byte_bpe, chat_tree, common, fingerprint, ngram_join, packing, quality, queries, sorted_table, substring_dedup, toxicity, url_lists
from terrace.llm.common import materialize
from terrace.llm.tokens import ByteBPE, Library, PerfectHash, load_ranks

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, kept string, score string, removed string"

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60)) + "."


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "x", "x", "x") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    base = text(200)
    near = base.split()
    near[100] = "changed"
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, base), (5, base), (6, " ".join(near)), (7, "one two"), (8, "ONE two"), (9, LONG), (10, f"{text(30)}. {PASSAGE} {text(20)}."), (11, f"{text(25)}. {PASSAGE} {text(9)}."), (12, "You are not an idiot. You idiot, they said!"), (12, "a second row of one id"), (None, "no id at all"), (-3, "é ß 日本 \U0001f600 'll <|endoftext|>  x\n\n y ")]
    return docs(spark, rows).cache(), rows


def empty(spark):
    return docs(spark, [])


def test_perfect_hash():
    items = load_ranks(RANKS)
    found = PerfectHash(dict(list(items.items())[:3000]))
    assert all(found.find(k) == v for k, v in list(items.items())[:3000]) and found.find(b"\xff\xfenone") is None
    assert PerfectHash({}).find(b"a") is None


def test_encoders_match_the_libraries():
    rng = random.Random(1)
    parts = [" ", "  ", "\n", " \n", "\t", "a", "Bc", "é", ".", ",", "1", "\x1c", "\x85", "'s", "<|endoftext|>", "日", "x" * 30, "İ", "Σ", "\u0301", "\xa0", "|", "🙂"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)] + ["İ.", "aİ, b"]
    texts += [" " * 300_000, "a" * 300_000, "!" * 50_000, "x" + "\n \n" * 50_000, "9" * 50_000, " " * 499 + "b", "Ünï'll don't — 3½ naïve façade's ½"]
    ours = ByteBPE(RANKS, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})
    for t in texts:
        ids = ours.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(t) and ours.decode(ids) == t.encode()
    for path, cut in ((JSON, "space"), (WORDS, "words")):
        lib = Library(path, cut)
        for t in texts:
            assert lib.encode(t) == lib.whole(t)


def test_byte_bpe(spark, odd):
    table, rows = odd
    out = byte_bpe.decode(byte_bpe.encode(table, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()
    assert Counter(bytes(r["decoded"]) for r in out) == Counter((t or "").encode() for _, t in rows)
    assert byte_bpe.encode(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_byte_bpe_round_trip(spark, odd):
    table, rows = odd
    theirs = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(RANKS), special_tokens={})
    out = byte_bpe.round_trip(table.select("doc_id", "text", "lang"), RANKS, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "lang", "ids", "n_tokens", "decoded"]
    found = Counter((r["doc_id"], bytes(r["ids"]), r["n_tokens"], bytes(r["decoded"])) for r in out.collect())
    ids = [(i, t or "", theirs.encode_ordinary(t or "")) for i, t in rows]
    assert found == Counter((i, np.array(x, "<u4").tobytes(), len(x), t.encode()) for i, t, x in ids)
    assert byte_bpe.round_trip(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0
    assert plan_of(queries.op4_byte_bpe(spark, SF)).count("MapInArrow") == 1


def test_byte_bpe_merges_a_word_once():
    ours, merged = ByteBPE(RANKS, public_tokenizers.PATTERN), []
    ours.merge = lambda key: merged.append(key) or [0]
    letters = str.maketrans("0123456789", "qxzjkvwyhg")
    text = " ".join(f"{i:06d}".translate(letters) for i in range(250_000))
    for _ in range(2):
        ours.encode(text)
    assert len(merged) == len(set(merged)) > 240_000


def test_plain_texts_go_to_the_table_whole():
    rng = random.Random(5)
    marks = [chr(i) for i in range(9, 256)] + ["'s", "'S", "'re", "'r", "'ll", "'d", "''", "!'s", "5's", " ", " ", "e", "tion", "\u2019s", "日"]
    lib, alone = Library(WORDS, "words"), []
    for _ in range(4000):
        t = "".join(rng.choice(marks) for _ in range(rng.randint(0, 25)))
        assert lib.encode(t) == lib.whole(t)
    plain = " ".join(f"It's {i} Naïve: «L'Été», x{i}y don'ts ''s ..." for i in range(200))
    answer = lib.memo.encode
    lib.memo.clear()
    lib.memo.old, lib.memo.encode = {}, lambda piece: alone.append(piece) or answer(piece)
    assert lib.encode(plain) == lib.whole(plain) and not alone
    mixed = f"{plain} they\u2019re few {plain}"
    assert lib.encode(mixed) == lib.whole(mixed) and alone == ["they\u2019re".encode()]


def test_packing_counts_where_it_encodes(spark, odd, monkeypatch):
    table, written = odd[0], []
    monkeypatch.setattr(common, "materialize", lambda df, name: written.append(df) or materialize(df, name))
    assert packing.pack(table, JSON, window=64).count()
    assert [plan_of(df).count("MapInArrow") for df in written] == [1] and "text" not in written[0].columns


def test_map_batches_sends_kept_inputs_once(spark, odd):
    table = odd[0].select("doc_id", "text")
    sent, _, schema = common.mapped(table, lambda text, i: (len(text or ""),), ["text", "doc_id"], [("n", T.LongType())])
    assert len(sent.columns) == 2 and schema.names == ["doc_id", "text", "n"]
    out = common.map_batches(table, lambda text, i: (len(text or ""),), ["text", "doc_id"], [("n", T.LongType())], drop=("text",))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(((i, len(t or "")) for i, t in odd[1]), key=str)


def test_classifier_keeps_an_answer_once():
    classify = toxicity.Classifier({})
    assert classify(b"table") is classify(b"chair") and classify(b"table.") is classify(b"chair!")


def test_sorted_table(spark, odd, tmp_path):
    table, rows = odd
    folder = f"file://{tmp_path}/sst"
    manifest = sorted_table.write(table, WORDS, "words", 2, folder, shard_bytes=1000, block_bytes=200)
    out = sorted(sorted_table.read(spark, manifest, folder).collect(), key=lambda r: r["start"])
    lib = Library(WORDS, "words")
    expected = [(i, lib.whole(t or "") + np.uint32(2).tobytes()) for i, t in sorted(((i, t or "") for i, t in rows if i is not None))]
    assert [(r["doc_id"], bytes(r["ids"])) for r in out] == expected
    assert [r["start"] for r in out] == [sum(len(x) // 4 for _, x in expected[:k]) for k in range(len(expected))]
    for r in manifest.collect():
        shard = sorted_table.Shard(open(r["path"].removeprefix("file://"), "rb").read())
        for i in range(r["first_id"], r["last_id"] + 1):
            assert shard.find(i) == [x for k, x in expected if k == i and r["first_id"] <= k <= r["last_id"]] or i == 12
        assert shard.find(10**12) == []
    asked = [9, 12, 12, None, 10**12, *(k for k, _ in expected[::2])]
    found = sorted_table.lookup(manifest, spark.createDataFrame([(i,) for i in asked], "doc_id long")).collect()
    assert sorted((r["doc_id"], bytes(r["ids"])) for r in found) == sorted(e for e in expected if e[0] in asked)
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in found)
    none = sorted_table.write(empty(spark), WORDS, "words", 2, folder + "0")
    assert none.count() == 0 and sorted_table.lookup(none, manifest.select(F.col("first_id").alias("doc_id"))).count() == 0
    assert sorted_table.digests(sorted_table.round_trip(empty(spark), WORDS)).count() == 0


def test_packing(spark, odd):
    table, rows = odd
    pieces = packing.pack(table, JSON, window=64).collect()
    lib = Library(JSON, "space")
    stream = {}
    for p in pieces:
        assert p["length"] * 4 == len(p["ids"]) and p["offset"] + p["length"] <= 64
        stream[p["sequence_id"] * 64 + p["offset"]] = p
    at = 0
    for place in sorted(stream):
        assert place == at
        at += stream[place]["length"]
    assert at == sum(len(lib.whole(t or "")) // 4 + 1 for _, t in rows)
    mine = b"".join(bytes(p["ids"]) for p in sorted((p for p in pieces if p["doc_id"] == 9), key=lambda p: p["start"]))
    assert mine == lib.whole(LONG) + np.uint32(1).tobytes()
    assert packing.digests(packing.pack(table.where("doc_id = 2"), JSON)).first()["ids_crc32"] == zlib.crc32(np.uint32(1).tobytes())
    assert packing.pack(empty(spark), JSON).count() == 0


def test_quality(spark, odd):
    table, rows = odd
    word = re.compile(r"[^\x20\x09-\x0D]+")
    more = [(100 + i, " ".join(random.Random(i).choice("abc") for _ in range(60)) + "\nline\nline") for i in range(5)]
    out = {r["doc_id"]: r for r in quality.measure(docs(spark, more + [r for r in rows if r[0] != 12])).collect()}
    for i, t in more + [r for r in rows if r[0] != 12]:
        w = word.findall(t or "")
        seen = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
        assert (out[i]["n_words"], out[i]["n_repeat_words"], out[i]["word_chars"]) == (len(w), len(covered), sum(map(len, w)))
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in rows if i], "doc_id long, quality int, toxic int")
    measured = materialize(quality.measure(table), "t")
    judged = quality.judge(measured, quality.cutoffs(measured, labels))
    assert judged.count() == len(rows) and judged.where("kept and base_failed").count() == 0
    # a brute-force version of every count, of the base rules and of the verdict
    for i, t in more + [r for r in rows if r[0] not in (12, None)]:
        w, lines = word.findall(t or ""), [line for line in (t or "").split("\n") if word.search(line)]
        assert out[i]["n_symbols"] == sum(c in "#*$%&|<>" for c in t or "") and out[i]["n_dup_lines"] == len(lines) - len(set(lines)) and out[i]["n_lines"] == len(lines)
        assert out[i]["base_failed"] == (len(w) < 50 or 100 * out[i]["n_repeat_words"] > 50 * len(w))
    clash = table.withColumns({c: F.lit("x") for c in ("stratum", "cut_symbols", "__words", "__spots", "marked", "of", "__stratum")})
    measured = materialize(quality.measure(clash), "t")
    again = quality.judge(measured, quality.cutoffs(measured, labels))
    assert again.columns == measured.columns and again.count() == len(rows) and again.where("__words = 'x' and stratum = 'x'").count() == len(rows)
    none = materialize(quality.measure(empty(spark)), "t")
    assert quality.judge(none, quality.cutoffs(none, labels)).count() == 0


def test_quality_repeats_under_colliding_hashes(spark, monkeypatch):
    """Windows of one hash whose equal ones stand apart, since others lie between them by position."""
    monkeypatch.setattr(quality, "gram_hash", lambda a, b, c: F.length(a).cast("long"))
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["a", "b", "cc", "dd", f"x{rng.randrange(99)}"]) for _ in range(rng.randint(0, 90)))) for i in range(60)]
    rows += [(60, "a b c a b d a b c"), (61, "a b c"), (62, "a a a a"), (63, None)]
    out = {r["doc_id"]: r["n_repeat_words"] for r in quality.measure(docs(spark, rows)).select("doc_id", "n_repeat_words").collect()}
    for i, t in rows:
        assert out[i] == repeat_words((t or "").split()), t


def repeat_words(w):
    seen = Counter(zip(w, w[1:], w[2:], strict=False))
    return len({k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)})


def verdicts(texts, langs, marks, risk=0.04, error=0.05, enough=0.98):
    """kept by id, in plain Python with exact binomial sums: texts and languages by id, labels (id, quality)."""
    from fractions import Fraction
    from math import comb

    word = re.compile(r"[^\x20\x09-\x0D]+")
    names = ("dup_lines", "repeats", "symbols", "upper")
    bins, failed = {}, {}
    for i, t in texts.items():
        w, lines = word.findall(t or ""), [x for x in (t or "").split("\n") if word.search(x)]
        chars, twice = sum(map(len, w)), repeat_words(w)
        pairs = {"dup_lines": (len(lines) - len(set(lines)), len(lines)), "repeats": (twice, len(w)), "symbols": (sum(c in "#*$%&|<>" for c in t or ""), chars), "upper": (sum(unicodedata.category(c) == "Lu" for c in t or ""), chars)}
        bins[i] = {r: int(min(a / b, 1.0) * 200) if b else 0 for r, (a, b) in pairs.items()}
        failed[i] = len(w) < 50 or 100 * twice > 50 * len(w)
    marked = {}
    for i, q in marks:
        if q is not None:
            marked[i] = min(q, marked.get(i, q))
    held = {}
    for i, q in marked.items():
        if i in texts and not failed[i]:
            held.setdefault(langs[i] or "", {0: [], 1: []})[q].append(i)

    def at_most(k, n, p):
        return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    cuts = {}
    for lang, of in held.items():
        choices = {}
        for parts in (1, 2, 4):
            found = []
            for r in names:
                tested = []
                for b in sorted({bins[i][r] for q in of.values() for i in q}, reverse=True):
                    k = sum(bins[i][r] > b for i in of[1])
                    if at_most(k, len(of[1]), Fraction(str(risk)) / parts) * len(held) * 12 > Fraction(str(error)):
                        break
                    tested.append((b, sum(bins[i][r] > b for i in of[0])))
                most = max((c for _, c in tested), default=0)
                if most:
                    found.append((-most, r, max(b for b, c in tested if c >= enough * most)))
            choice = {r: b for _, r, b in sorted(found)[:parts]}
            if choice:
                choices[parts] = (sum(any(bins[i][r] > b for r, b in choice.items()) for i in of[0]), choice)
        if choices:
            most = max(n for n, _ in choices.values())
            cuts[lang] = next(choice for n, choice in (choices[p] for p in sorted(choices)) if n >= enough * most)
    kept = {i: not failed[i] and not any(bins[i][r] > b for r, b in cuts.get(langs[i] or "", {}).items()) for i in texts}
    return kept, cuts


def test_quality_verdicts_against_brute_force(spark):
    """Cutoffs of every stratum and kept of every row, on the given tables and on made strata."""
    for folder in (SF, "/root/testdata/sf0.01"):
        table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()
        labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality").collect()
        expected, cuts = verdicts({r[0]: r[1] for r in table}, {r[0]: r[2] for r in table}, [(r[0], r[1]) for r in labels])
        assert {r["doc_id"]: r["kept"] for r in queries.op5_quality_rules(spark, folder).collect()} == expected
    assert cuts and not all(expected.values())
    # strata whose bad documents show by one rule, by two, or not at all, and one of too few labels; two labels for one document
    rng, rows, marks = random.Random(12), [], []
    for lang, size in (("a", 420), ("b", 900), (None, 500), ("d", 20)):
        for k in range(size):
            i, bad = len(rows), k % 6 == 0
            words = [f"q{i}x{j}" for j in range(60)]
            if bad and lang in ("a", "d"):
                words += ["###"] * rng.randint(1, 20)
            if bad and lang == "b":
                words = [x.upper() for x in words] if k % 4 else words + ["$$$"] * 15
            if not bad and rng.random() < 0.01:
                words += ["%"] * rng.randint(1, 9)
            rows.append((i, " ".join(words), lang))
            marks += [(i, 0 if bad else 1)] + [(i, 1)] * (k % 50 == 0)
    expected, cuts = verdicts({i: t for i, t, _ in rows}, {i: x for i, _, x in rows}, marks)
    measured = materialize(quality.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string")), "t")
    limits = quality.cutoffs(measured, spark.createDataFrame(marks, "doc_id long, quality int"))
    found = {r["stratum"]: {k: r[f"cut_{k}"] for k in ("dup_lines", "repeats", "symbols", "upper") if r[f"cut_{k}"] is not None} for r in limits.collect()}
    assert found == cuts and len(cuts["b"]) > 1 and set(cuts) == {"a", "b"}
    assert {r["doc_id"]: r["kept"] for r in quality.judge(measured, limits).collect()} == expected


def test_binomial_bound(spark):
    from math import comb

    cases = [(0, 10), (3, 400), (40, 5000), (0, 300)]
    rows = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality.binomial_at_most(F.col("k"), F.col("n"), 0.01).alias("p")).collect()
    for r in rows:
        exact = sum(comb(r["n"], i) * 0.01**i * 0.99 ** (r["n"] - i) for i in range(r["k"] + 1))
        assert r["k"] >= r["n"] * 0.01 or abs(r["p"] - exact) < 1e-9


def test_binomial_bound_beyond_its_terms(spark):
    rows = spark.createDataFrame([(30, 5000)], "k long, n long")
    exact, bound = rows.select(quality.binomial_at_most(F.col("k"), F.col("n"), 0.01), quality.binomial_at_most(F.col("k"), F.col("n"), 0.01, terms=8)).first()
    assert exact <= bound < 1.3 * exact


def test_small_strata_have_cutoffs(spark):
    text = lambda i, mark: " ".join(f"{mark}{i}x{j}" for j in range(60))
    good, junk = [(i, text(i, "g")) for i in range(300)], [(500 + i, text(i, "j") + " ###" * 20 ) for i in range(30)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in junk], "doc_id long, quality int")
    measured = materialize(quality.measure(docs(spark, good + junk)), "t")
    kept = {r["doc_id"] for r in quality.judge(measured, quality.cutoffs(measured, labels)).where("kept").collect()}
    assert kept == {i for i, _ in good}


def test_cutoffs_hold_risk_and_catch_junk(spark):
    good = [(i, " ".join(f"g{i}x{j}" for j in range(60))) for i in range(1500)]
    junk = [(5000 + i, " ".join(f"j{i}x{j}###" for j in range(60))) for i in range(200)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in junk], "doc_id long, quality int")
    measured = materialize(quality.measure(docs(spark, good + junk)), "t")
    kept = {r["doc_id"] for r in quality.judge(measured, quality.cutoffs(measured, labels)).where("kept").collect()}
    assert len(kept & set(range(1500))) >= 1440 and not kept & set(range(5000, 5200))


def test_toxicity(spark, odd):
    table, rows = odd
    machine = toxicity.grammar(toxicity.prior())
    classify = toxicity.Classifier({})
    seen = [m for found, _ in toxicity.clauses(machine, classify, rows[11][1]) for m in found]
    assert seen == [(toxicity.INSULT, 1, 1, 0), (toxicity.INSULT, 1, 0, 1)]
    # "he" is a target word: it marks up to four words on, and no further
    for said, at in (("someone said what an idiot.", 0), ("he said what an idiot.", 1), ("he said oh what an idiot.", 0)):
        assert [m for f, _ in toxicity.clauses(machine, classify, said) for m in f] == [(toxicity.INSULT, at, 0, 1)]
    labels = spark.createDataFrame([(12, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.score(table, toxicity.fit(table, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(empty(spark), toxicity.fit(empty(spark), labels.limit(0))).count() == 0


def test_toxicity_machine_is_the_grammar():
    """The composed machine against each rule read word by word."""
    rng = random.Random(7)
    pool = {"idiot": toxicity.INSULT, "kill": toxicity.THREAT, "you": toxicity.TARGET, "not": toxicity.NEGATION, "said": toxicity.REPORT, "maybe": toxicity.DOUBTFUL, "word": toxicity.NONE, "other": toxicity.NONE}
    machine, weights = toxicity.grammar(toxicity.prior()), toxicity.prior()
    classify = toxicity.Classifier({"maybe$": toxicity.DOUBTFUL})
    for _ in range(400):
        words = [rng.choice(list(pool)) + rng.choice(["", "", "", ".", "!"]) for _ in range(rng.randint(1, 30))]
        expected, clause = [], []
        for w in [*words, None]:
            if w is not None:
                clause.append(pool[w.strip(".!")])
            if clause and (w is None or w[-1] in ".!"):
                found = []
                for i, k in enumerate(clause):
                    if k in toxicity.KINDS:
                        found.append((k, int(toxicity.TARGET in clause[max(0, i - 4) : i + 5]), int(toxicity.NEGATION in clause[max(0, i - 3) : i]), int(toxicity.REPORT in clause)))
                if found:
                    expected.append((found, sum(weights[m] for m in set(found))))
                clause = []
        got = list(toxicity.clauses(machine, classify, " ".join(words)))
        assert [f for f, _ in got] == [f for f, _ in expected]
        assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(got, expected, strict=True))


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = queries.op1_toxicity(spark, folder).where("held_out").join(labels, "doc_id")
    right, caught = out.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")), F.avg(F.when(F.col("toxic") == 1, F.col("predicted")))).first()
    assert right > 0.97 and caught > 0.86
    assert out.where("predicted = 1 and toxic = 0").count() <= 5


CONTEXTS = [("you idiot.", 1), ("what a moron you are.", 1), ("i will kill you.", 1), ("we will hurt them.", 1), ("you are not an idiot.", 0), ("she is no fool.", 0), ("kill the process.", 0), ("i will not kill you.", 0), ("do not hurt them.", 0), ("he said i will kill you.", 0), ("the paper reported he would kill them.", 0), ("beat the eggs.", 0), ("plain words.", 0)]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1", "/root/testdata/sf0.01"])
def test_toxicity_contexts_decide(spark, folder):
    """Contexts have the right sign with fitted weights, and are worth more than ignoring them or any one weight for all."""
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(table, spark.read.parquet(f"{folder}/labels.parquet"))

    def totals(weights, texts):
        machine, classify = toxicity.grammar(weights), toxicity.Classifier(model.stems)
        return [model.bias + model.a_length * toxicity.length(t) / 10 + sum(s for _, s in toxicity.clauses(machine, classify, t)) for t in texts]

    wrong = lambda weights: sum((t > 0) != bool(label) for t, (_, label) in zip(totals(weights, [c for c, _ in CONTEXTS]), CONTEXTS, strict=True))
    at_you, plain, negated = totals(model.weights, ["you idiot.", "idiot.", "not an idiot."])
    assert at_you > plain > negated and wrong(model.weights) == 0
    ignored = {m: model.weights[(m[0], 0, 0, 0)] for m in toxicity.MATCHES}
    assert wrong(ignored) > 2 and min(wrong(dict.fromkeys(toxicity.MATCHES, flat / 4)) for flat in range(60)) > 2
    for kind in toxicity.KINDS:
        for t, n, r in [(0, 0, 0), (0, 1, 0), (0, 0, 1), (0, 1, 1)]:
            assert model.weights[(kind, 1, n, r)] > model.weights[(kind, t, n, r)]
        assert model.weights[(kind, 1, 1, 0)] < model.weights[(kind, 1, 0, 0)] > model.weights[(kind, 1, 0, 1)]


def test_ngram_join(spark, odd, monkeypatch):
    table, rows = odd
    out = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in ngram_join.link_components(table, 3, 90).collect()}
    by = {i: c for (i, _), c in out.items()}
    assert by[4] == by[5] == by[6] == 4 and by[7] == by[8] == 7 and by[1] == 1 and by[2] == 2 and by[9] == 9 and by[None] is None
    assert ngram_join.link_components(empty(spark), 3, 90).count() == 0
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    many = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        many.append((i, " ".join(words)))
    expected = brute(many, 3, 90)
    # texts that have half of their words, rare ones, in common without a link, so that lists keep several components
    for i in range(40):
        half = [f"r{j}" for j in range(50)] + [f"o{i // 4}x{j}" for j in range(60)]
        half[60 + i % 4] = f"y{i}"
        many.append((100 + i, " ".join(half)))
    expected = brute(many, 3, 90)
    calls: list[int] = []
    shape = ngram_join.viable
    monkeypatch.setattr(ngram_join, "viable", lambda percent: calls.append(percent) or shape(percent))
    for block in (5, 256):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        found = {r["doc_id"]: r["component_id"] for r in ngram_join.link_components(docs(spark, many), 3, 90).collect()}
        assert found == expected
    assert calls and len(set(expected.values())) > 10


def test_product_counts_overlaps():
    rng = random.Random(4)
    sets = [np.array(sorted({rng.randrange(60) for _ in range(rng.randint(0, 40))}), np.uint64) for _ in range(30)]
    for at_once in (7, 1 << 20):
        ngram_join.AT_ONCE, before = at_once, ngram_join.AT_ONCE
        over = ngram_join.overlaps(sets[:12], sets[12:])
        ngram_join.AT_ONCE = before
        assert over.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[12:]] for a in sets[:12]]
    assert ngram_join.overlaps([], sets).shape == (0, 30)


def test_sketches_bound_differences():
    rng = random.Random(6)
    rows = []
    for _ in range(200):
        base = {rng.randrange(1 << 60) for _ in range(rng.randint(1, 300))}
        other = {x for x in base if rng.random() > 0.1} | {rng.randrange(1 << 60) for _ in range(rng.randint(0, 40))}
        rows.append((base, other or {1}))
    for percent in (80, 90):
        sets = [[np.array(sorted(x), np.uint64) for x in side] for side in zip(*rows, strict=True)]
        sketches = [[np.frombuffer(ngram_join.sketch_of(x), np.uint8) for x in side] for side in sets]
        may = ngram_join.may_link(*(np.array([len(x) for x in side]) for side in sets), *sketches, percent)
        links = np.array([100 * len(a & b) >= percent * len(a | b) for a, b in rows])
        assert links.any() and not (links & ~may).any() and (~may).sum() > 20


def test_ngram_join_runs_the_product_on_the_tables(spark, monkeypatch):
    """The tiles of the product, and not its first rows alone, have work on the given documents."""
    rows, shape = {}, ngram_join.materialize

    def counting(df, name):
        out = shape(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "materialize", counting)
    docs_ = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.link_components(docs_, 5, 80).collect()}
    assert out == brute([(r["doc_id"], r["text"] or "") for r in docs_.collect()], 5, 80)
    assert rows["stars"] and rows["tiles"] and rows["tile-rows"]
    # chains of edits of given texts, each linked to the next and not to those far off: lists keep several components after their first rows, which only tiles can link
    rng, chained = random.Random(2), []
    for r in docs_.where("doc_id < 100").collect():
        words = (r["text"] or "").split()
        step = len(words) // 25
        for k in range(8 if step else 0):
            chained.append((r["doc_id"], " ".join(words)))
            start = len(words) - (k + 1) * step
            words[start : start + step] = [f"e{k}x{j}" for j in range(step)]
    ids = rng.sample(range(10**6), len(chained))
    chained = [(i, t) for i, (_, t) in zip(ids, chained, strict=True)]
    for block in (3, 256):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        out = {r["doc_id"]: r["component_id"] for r in ngram_join.link_components(docs(spark, chained), 5, 80).collect()}
        assert out == brute(chained, 5, 80)
        assert rows["tile-rows"] > 50


def test_first_rows_meet_a_tile_at_once(monkeypatch):
    rng = random.Random(9)
    sets = [np.array(sorted(rng.sample(range(40), 36)), np.uint64) for _ in range(24)]
    rows = [(lead, 0, side, 100 * lead + k, s.tobytes()) for lead, part in ((1, sets[:15]), (2, sets[15:])) for k, s in enumerate(part) for side in [int(k > 0)]]
    shapes, count = [], ngram_join.overlaps
    monkeypatch.setattr(ngram_join, "overlaps", lambda a, b: shapes.append((len(a), len(b))) or count(a, b))
    expected = {(100 * lead, 100 * lead + k) for lead, part in ((1, sets[:15]), (2, sets[15:])) for k, s in enumerate(part) if k and 100 * len(set(part[0]) & set(s)) >= 82 * len(set(part[0]) | set(s))}
    for at in (1, 7, 24):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + at], strict=True)], names=["lead", "salt", "side", "id", "grams"]) for k in range(0, 24, at)]
        found = [x for b in ngram_join.against_first(82)(iter(batches)) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert sorted(found) == sorted(expected)
    assert 0 < len(expected) < 22 and shapes[-2:] == [(1, 14), (1, 8)]


def test_ngram_join_repeated_id(spark):
    text = lambda k: " ".join(f"t{k}w{j}" for j in range(40))
    rows = [(1, text(1)), (2, text(2)), (3, text(1)), (3, text(2)), (4, text(3)), (None, text(1))]
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.link_components(docs(spark, rows), 3, 90).collect()}
    assert out == {1: 1, 2: 1, 3: 1, 4: 4, None: None}


def brute(rows, width, percent):
    words = {i: t.encode().lower().split() for i, t in rows}
    number = {}
    sets = {i: {number.setdefault(tuple(w[k : k + width]), len(number)) for k in range(max(1, len(w) - width + 1))} if w else set() for i, w in words.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * (over := len(sets[a] & sets[b])) >= percent * (len(sets[a]) + len(sets[b]) - over):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: root(i) for i in sets}


def test_substring_dedup(spark, odd):
    table, rows = odd
    out = {r["doc_id"]: r for r in substring_dedup.dedup(table).collect() if r["doc_id"] not in (12, None)}
    texts = {i: t for i, t in rows if i not in (12, None)}
    assert out[10]["text"] == texts[10] and "shared5 " not in out[11]["text"] and out[11]["n_removed"] == 1
    assert out[5]["text"] == "" and out[4]["n_removed"] == 0 and out[1]["text"] is None
    for i, r in out.items():
        rest = list(texts[i] or "")
        for s in r["removed"]:
            rest[s["start"] : s["end"]] = [""] * (s["end"] - s["start"])
        assert "".join(rest) == (r["text"] or "")
    assert substring_dedup.dedup(empty(spark)).count() == 0
    clash = table.withColumns({c: F.lit("x") for c in ("__id", "__of", "__cuts", "first", "h1")})
    assert substring_dedup.dedup(clash).where("__id = 'x' and __cuts = 'x'").count() == len(rows)
    short = docs(spark, [(1, f"{PASSAGE} Yes. No. {PASSAGE}"), (2, f"Yes. Else here. {PASSAGE} Yes. No. End.")])
    second = {r["doc_id"]: r["text"] for r in substring_dedup.dedup(short).collect()}
    assert second[2] == "Yes. Else here. End." and second[1] == f"{PASSAGE} Yes. No. "


def test_substring_dedup_cuts_each_row_of_an_id_by_its_own_text(spark, odd):
    table, rows = odd
    own = " ".join(f"own{i}" for i in range(90)) + "."
    more = [(1, PASSAGE), (12, own), (12, f"Lead. {PASSAGE} End."), (12, f"{own} {own} {PASSAGE}")]
    out = Counter((r["text"], r["n_removed"]) for r in substring_dedup.dedup(docs(spark, more)).collect() if r["doc_id"] == 12)
    assert out == Counter([(own, 0), ("Lead. End.", 1), (f"{own} ", 2)])
    both = {r["text"]: r["n_removed"] for r in substring_dedup.dedup(table).collect() if r["doc_id"] == 12}
    assert both == {t: 0 for i, t in rows if i == 12}


def test_substring_dedup_finds_short_units(spark):
    said = lambda k: " ".join(f"p{k}w{j}" for j in range(7)) + "."
    passage = " ".join(said(k) for k in range(70))
    lead = lambda i: " ".join(f"lead{i}x{j}" for j in range(11)) + "."
    nine = "The and attion to thanedble the, anea. Hash on."
    han = "我们把每一行文字都按原样处理。然后再看它的句子。"
    rows = [(1, f"{lead(1)} {passage} {lead(2)}"), (2, f"Short. {passage} End."), (3, f"{nine}\n{lead(3)}"), (4, f"{lead(4)}\n{nine}\nOh."), (5, f"甲乙丙。{han}"), (6, f"丁戊。{han}己庚。"), (7, f"{lead(7)} Tail one. And two."), (8, f"Oh. {lead(7)} Tail one. Other."), (9, "Ha. " * 20)]
    for unit in ("sentence", "line"):
        out = {r["doc_id"]: r for r in substring_dedup.dedup(docs(spark, rows), unit, 8).collect()}
        assert all(out[i]["n_removed"] == 0 for i in (1, 3, 5, 7))
        assert out[4]["text"] == f"{lead(4)}\nOh." and out[4]["n_removed"] == 1
        if unit == "sentence":
            assert {i: out[i]["text"] for i in (2, 6, 8)} == {2: "Short. End.", 6: "丁戊。己庚。", 8: "Oh. Other."}
            # what stays of a text that repeats itself holds the whole run
            assert out[9]["text"] == "Ha. " * 8
    # brute force: a unit goes where its whole line, or a run of whole units that has it, of 8 words or more, lies in an earlier text
    rng = random.Random(8)
    pool = [" ".join(f"u{k}v{j}" for j in range(rng.randint(1, 10))) + "." for k in range(25)]
    many = [(i, [rng.randrange(25) for _ in range(rng.randint(1, 14))]) for i in range(40)]
    out = {r["doc_id"]: r["text"] for r in substring_dedup.dedup(docs(spark, [(i, " ".join(pool[k] for k in ks)) for i, ks in many]), "sentence", 8).collect()}
    had: set = set()
    for i, ks in many:
        runs = [(a, b) for a in range(len(ks)) for b in range(a + 1, len(ks) + 1) if sum(len(pool[k].split()) for k in ks[a:b]) >= 8 or b - a == len(ks)]
        gone = {u for a, b in runs if tuple(ks[a:b]) in had or any(tuple(ks[c:d]) == tuple(ks[a:b]) and d <= a for c, d in runs) for u in range(a, b)}
        assert out[i].split() == " ".join(pool[k] for u, k in enumerate(ks) if u not in gone).split(), i
        had |= {tuple(ks[a:b]) for a, b in runs}


def test_substring_dedup_at_its_production_setting(spark):
    """Texts put together from known sentences, so that the brute force splits nothing: a sentence goes where its whole line, or a run of whole sentences of 20 words or more that has it, was there before."""
    rng = random.Random(21)
    pool = [" ".join(f"s{k}t{j}" for j in range(rng.choice([1, 2, 5, 9, 14, 26]))) + "." for k in range(40)]
    shared = [[rng.randrange(40) for _ in range(rng.randint(1, 3))] for _ in range(12)]
    many = [(i, [rng.choice(shared) if rng.random() < 0.5 else [rng.randrange(40) for _ in range(rng.randint(1, 6))] for _ in range(rng.randint(1, 7))]) for i in range(60)]
    rows = [(i, "\n".join(" ".join(pool[k] for k in line) for line in text)) for i, text in many]
    out = {r["doc_id"]: r["text"] for r in substring_dedup.dedup(docs(spark, [*rows, (90, "---\nTail ninety"), (91, "---\ntail  NINETY\nown")])).collect()}
    had: set = set()
    for i, text in many:
        flat = [k for line in text for k in line]
        ends = np.cumsum([len(line) for line in text]).tolist()
        spans = {(end - len(line), end) for line, end in zip(text, ends, strict=True)}
        spans |= {(a, b) for a in range(len(flat)) for b in range(a + 1, len(flat) + 1) if sum(len(pool[k].split()) for k in flat[a:b]) >= 20}
        first: dict = {}
        for a, b in sorted(spans):
            first.setdefault(tuple(flat[a:b]), b)
        gone = {u for a, b in spans if tuple(flat[a:b]) in had or first[tuple(flat[a:b])] <= a for u in range(a, b)}
        assert out[i].split() == " ".join(pool[k] for u, k in enumerate(flat) if u not in gone).split(), i
        had |= set(first)
    # lines without a letter or digit are no units, short ones are
    assert out[90] == "---\nTail ninety" and out[91] == "---\nown"


def test_substring_dedup_leaves_no_repeated_line(spark):
    """On a whole table: of every line that carries a letter or digit, the occurrences after the first are gone, whatever their length."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    seen, later = set(), 0
    for r in sorted(substring_dedup.dedup(table.withColumn("was", F.col("text"))).collect(), key=lambda r: r["doc_id"]):
        cut = np.zeros(len(r["was"] or "") + 1, bool)
        for span in r["removed"]:
            cut[span["start"] : span["end"]] = True
        at = 0
        for line in (r["was"] or "").split("\n"):
            words = " ".join(unicodedata.normalize("NFKC", line).lower().split())
            if any(c.isalnum() for c in words) and words in seen:
                later += 1
                assert all(cut[at + k] or c.isspace() for k, c in enumerate(line)), (r["doc_id"], line)
            seen.add(words)
            at += len(line) + 1
    assert later > 500


def test_chat_tree(spark):
    rows = [(1, 0, "user", "a<b> \\l"), (1, 1, "assistant", "</turn> ok"), (2, 0, "user", "a<b> \\l"), (2, 1, "assistant", "other"), (3, 0, "user", "a<b> \\l"), (3, 1, "assistant", "</turn> ok"), (4, 0, None, None), (None, 0, "user", "x"), (5, 1, "user", "tie"), (5, 1, "user", "tie")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes, members = chat_tree.build(table)
    got = nodes.orderBy("emitted").collect()
    at = 0
    for r in got:
        assert r["emitted"] == at and r["attends"][-1] == (at, at + r["size"]) and r["position"] == sum(b - a for a, b in r["attends"][:-1])
        at += r["size"]
    assert len(got) == 6  # one first turn for three, two answers, one alone, two tied
    read = {r["conv_id"]: r for r in chat_tree.digests(chat_tree.read_back(nodes, members)).collect()}
    for i in (1, 2, 3, 4, 5):
        mine = [(r or "", t or "") for c, _, r, t in rows if c == i]
        assert read[i]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest()
        assert read[i]["loss_sha256"] == hashlib.sha256("".join(t for r, t in mine if r == "assistant").encode()).hexdigest()
    assert chat_tree.read_back(*chat_tree.build(table.limit(0))).count() == 0


def test_chat_tree_reads_the_stream(spark):
    rng = random.Random(9)
    said = {}
    for c in range(40):
        said[c] = [rng.choice("ab") * rng.choice((1, 5, 900)) for _ in range(rng.randint(1, 9))]
    said[50] = [f"turn {k}" for k in range(300)]
    said[51] = said[50][:150] + ["other"]
    table = spark.createDataFrame([(c, k, "assistant" if k % 2 else "user", t) for c, ts in said.items() for k, t in enumerate(ts)], "conv_id long, turn long, role string, text string")
    nodes, members = chat_tree.build(table)
    # both are tables that were written with all columns
    assert nodes.inputFiles() and members.inputFiles()
    got = nodes.orderBy("emitted").collect()
    stream = "".join(r["formatted"] for r in got)
    owner = {r["node"]: r for r in got}
    paths: dict = {}
    for m in members.orderBy("conv_id", "depth").collect():
        paths.setdefault(m["conv_id"], []).append(owner[m["node"]])
    for c, path in paths.items():
        whole = [f"<turn {'assistant' if k % 2 else 'user'}>{t}</turn>\n" for k, t in enumerate(said[c])]
        assert "".join(stream[a:b] for a, b in path[-1]["attends"]) == "".join(whole)
        for k, r in enumerate(path):
            assert r["position"] == len("".join(whole[:k])) and all(a < b for a, b in r["attends"])
            assert all(x[1] < y[0] for x, y in zip(r["attends"], r["attends"][1:-1], strict=False))
    # 300 turns of two conversations: a list does not get longer with each turn
    assert max(len(r["attends"]) for r in paths[50] + paths[51]) <= 3
    read = {r["conv_id"]: [t["text"] for t in r["turns"]] for r in chat_tree.read_back(nodes, members).collect()}
    assert read == said
    # what is read depends on the intervals: without those of the turns above, only last turns are left
    cut = nodes.withColumn("attends", F.slice("attends", -1, 1))
    assert {r["conv_id"]: [t["text"] for t in r["turns"]] for r in chat_tree.read_back(cut, members).collect()} == {c: ts[-1:] for c, ts in said.items()}


def test_fingerprints(spark, odd):
    table, rows = odd
    out = fingerprint.edits(table)
    got = fingerprint.digests(out).collect()
    assert len(got) == len(rows)
    order = sorted(((-(1 << 63) if i is None else i, t or "") for i, t in rows), key=lambda x: (-x[0], x[1]))
    expected = Counter()
    for k, (i, t) in enumerate(order):
        half, after = len(t) // 2, order[(k + 1) % len(order)][1]
        expected[None if i == -(1 << 63) else i, hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in got) == expected
    same = {r["doc_id"]: r["fingerprint"] for r in got}
    assert same[4] == same[5] != same[6] and all(0 <= r["near_edited"] <= 1 for r in got)
    assert fingerprint.digests(fingerprint.edits(empty(spark))).count() == 0
    one = fingerprint.with_sketch(table.where("doc_id = 9"), "text", "s").select(fingerprint.distinct_count(F.col("s")).alias("n")).first()["n"]
    assert 600 < one < 1400


def test_url_lists(spark):
    pages = spark.createDataFrame([(1, "http://u@A.x.com:80/p/q", "2024-01-10"), (2, "https://b.x.com.", "2024-02-10"), (3, None, "2024-01-10"), (4, "not a url", None), (1, "http://u@A.x.com:80/p/q", "2024-01-10")], "page_id long, url string, f string").withColumn("fetched", F.to_date("f"))
    entries = spark.createDataFrame([("x.com", "block", "2024-01-01"), ("x.com", "delist", "2024-02-01"), ("a.x.com/p", "allow", "2024-01-05"), (None, "block", "2024-01-01")], "key string, action string, d string").withColumn("dated", F.to_date("d"))
    out = {r["page_id"]: (r["verdict"], r["matched"]) for r in url_lists.judge(pages, entries).collect()}
    assert out == {1: ("allow", "a.x.com/p"), 2: ("none", None), 3: ("none", None), 4: ("none", None)}
    assert url_lists.judge(pages.limit(0), entries.limit(0)).count() == 0


def test_url_keys_ties_and_depth(spark):
    long_path = "/".join(f"p{i}" for i in range(400))
    pages = spark.createDataFrame([(1, "http://h.org/a/b/c?q=1#top"), (2, "http://h.org/a/b"), (3, "http://k.org/z?q=2"), (4, f"http://k.org/{long_path}"), (5, "http://only.zip/"), (6, "http:///none")], "page_id long, url string").withColumns({"fetched": F.to_date(F.lit("2024-03-01")), "key": F.lit("x"), "salts": F.lit("x")})
    listed = [("h.org", "block"), ("h.org/a/b", "allow"), ("h.org/a/b/c?q=1", "block"), ("k.org/z?q=2", "allow"), ("k.org/z?q=2", "block"), (f"k.org/{long_path}", "block"), ("zip", "block"), (None, "block")]
    entries = spark.createDataFrame([(k, a, "2024-02-01") for k, a in listed], "key string, action string, d string").withColumn("dated", F.to_date("d"))
    out = {r["page_id"]: (r["verdict"], r["matched"]) for r in url_lists.judge(pages, entries).collect()}
    # the longest key decides; of two actions on one day the least counts
    assert out == {1: ("block", "h.org/a/b/c?q=1"), 2: ("allow", "h.org/a/b"), 3: ("allow", "k.org/z?q=2"), 4: ("block", f"k.org/{long_path}"), 5: ("block", "zip"), 6: ("none", None)}
    assert {r["verdict"] for r in url_lists.judge(pages, entries.limit(0)).collect()} == {"none"}


def sketch_of(text):
    """Bottom-k sketch by brute force: blanks around the words, a chained 64-bit hash of each window cut to 48 bits."""
    words = [""] * 4 + re.findall(r"[^\x20\x09-\x0D]+", text) + [""] * 4
    found = set()
    for i in range(len(words) - 4):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64(w.encode(), seed=h).intdigest()
        found.add(h & ((1 << 48) - 1))
    return found, sorted(found)[:128]


def test_fingerprints_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] or "" for r in table.collect()}
    order = sorted(rows, reverse=True)
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    got = {r["doc_id"]: r for r in fingerprint.digests(fingerprint.edits(table)).collect()}
    assert set(got) == set(rows)

    def likeness(a, b):
        both = sorted(set(a) | set(b))[:128]
        return len(set(both) & set(a) & set(b)) / len(both)

    for i, text in rows.items():
        half, following = len(text) // 2, rows[after[i]]
        (all_, mine), (_, edited), (_, other) = sketch_of(text), sketch_of(text[: len(text) - half] + following[:half]), sketch_of(following)
        assert got[i]["n_chars"] == len(text) and got[i]["fingerprint"] == "".join(f"{h:012X}" for h in mine) and got[i]["edited_fingerprint"] == "".join(f"{h:012X}" for h in edited)
        assert got[i]["near_edited"] == pytest.approx(likeness(mine, edited)) and got[i]["near_next"] == pytest.approx(likeness(mine, other))
        # 127 hashes below the largest: a relative error of about 9 %, here within five times that
        assert got[i]["n_shingles"] == len(all_) if len(all_) < 128 else abs(got[i]["n_shingles"] / len(all_) - 1) < 0.45


def test_pipeline(spark):
    """Every stage against a plain version of it, on what the stage before kept."""
    import corpus_pipeline
    import tokenizers

    given = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    after, kept = given, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialize(stage(spark, after, SF), "stage")
        assert after.columns == given.columns, name
        kept.append({r["doc_id"]: r.asDict() for r in after.collect()})
    before = {r["doc_id"]: r.asDict() for r in given.collect()}
    word = re.compile(r"[^\x20\x09-\x0D]+")

    def base_failed(text):
        w = word.findall(text)
        seen = Counter(zip(w, w[1:], w[2:], strict=False))
        return len(w) < 50 or 100 * len({k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}) > 50 * len(w)

    good, toxic, apart, cut = kept
    # quality rules: what the base rules fail goes, nothing is changed, and good labels stay but for the risk
    assert all(good[i] == before[i] for i in good) and not any(base_failed(good[i]["text"] or "") for i in good)
    sound = [r["doc_id"] for r in labels.where("quality = 1").collect() if not base_failed(before[r["doc_id"]]["text"] or "")]
    assert sum(i in good for i in sound) >= 0.9 * len(sound)
    # toxicity: exactly what the operator predicts, of the whole of its input
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score(spark.createDataFrame(list(good.values()), given.schema), toxicity.fit(spark.createDataFrame(list(good.values()), given.schema), labels)).collect()}
    assert toxic == {i: r for i, r in good.items() if scored[i] == 0}
    # near duplicates: the least of each component by all pairs
    components = brute([(i, r["text"] or "") for i, r in toxic.items()], 5, 80)
    assert apart == {i: r for i, r in toxic.items() if components[i] == i}
    # passages: first occurrences in order of ids; a run that an earlier text has goes
    had: dict = {}
    for i in sorted(apart):
        text, spans, own = apart[i]["text"] or "", [], {}
        for start, end, digest in sorted(substring_dedup.units(text, "sentence")):
            if digest in had or own.setdefault(digest, end) <= start:
                spans.append((start, end))
        had.update(own)
        gone = set()
        for start, end in spans:
            gone.update(range(start, end))
        for k in range(len(text)):
            if text[k].isspace() and k - 1 in gone:
                gone.add(k)
        rest = "".join(c for k, c in enumerate(text) if k not in gone)
        assert cut[i]["text"] == rest and cut[i]["n_chars"] == len(rest), i
    assert set(cut) == set(apart)
    # packing: one gapless stream of all tokens, each text's in order and followed by its end
    library = tokenizers.Tokenizer.from_file(JSON)
    ids = {i: np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4") for i, r in cut.items()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, after, SF).collect()
    at = 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * 2048 + p["offset"] == at and p["offset"] + p["length"] <= 2048
        at += p["length"]
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert len(part) == p["length"] and zlib.crc32(part.tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
    assert at == sum(map(len, ids.values()))
    assert Counter((r["doc_id"], r["start"], r["length"]) for r in corpus_pipeline.run(spark, SF).collect()) == Counter((p["doc_id"], p["start"], p["length"]) for p in pieces)


def test_pipeline_stages_take_odd_rows(spark, odd):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables: every stage runs and returns the columns of documents."""
    import corpus_pipeline

    table, _ = odd
    for name, stage in corpus_pipeline.STAGES:
        clash = table.withColumns({c: F.lit("x") for c in ("marked", "component_id", "predicted", "cut_symbols", "part", "before", "row")})
        out = stage(spark, clash, SF)
        assert name == "packing" or out.columns == list(corpus_pipeline.COLUMNS), name
        assert out.count() > 0 and stage(spark, empty(spark), SF).count() == 0, name
