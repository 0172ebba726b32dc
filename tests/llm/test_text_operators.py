"""Single-document operators against brute force, the libraries themselves, or held-out data."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairstats.llm import mixing, packing, pii, quality_rules, toxicity
from pairstats.llm.common import fold_of, texts_of
from pairstats.llm.compression import score_quality
from pairstats.llm.pieces import Pieces, encoded_digests, model_path
from pairstats.llm.trie_counts import TrieCounter, piece_scores, token_counts

ALPHABET = "abcdethiosnr ▁ .,éñß漢字😀\n\t0123@+-()"


def random_texts(n, longest=80, alphabet=ALPHABET, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


# Tokens


def test_pieces_equal_the_library(texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    model = Pieces(model_path())
    odd = ["", " ", "  ", "▁", " a", "a  b   c ", " " * 40 + "x" + " " * 70, "<s> <unk> <0x41>"]
    for text in [*odd, "a" * 3000, *random_texts(1500), *list(texts.values())[:40]]:
        ids = library.encode(text)
        assert model.encode(text) == ids
        assert model.decode(ids) == library.decode(ids)


def test_piece_digests(documents, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for row in encoded_digests(documents).collect():
        ids = library.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha(",".join(map(str, ids)))
        assert row.decoded_sha256 == sha(library.decode(ids))


def brute_count(word, scores):
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        c = word[end - 1]
        n = len(c.encode())
        step = (scores[c], 1) if c in scores else (-n * 6_000_000, n)
        ways = [(best[end - 1][0] + step[0], best[end - 1][1] - step[1])]
        for start in range(end - 1):
            if word[start:end] in scores:
                ways.append((best[start][0] + scores[word[start:end]], best[start][1] - 1))
        best.append(max(ways))
    return -best[-1][1], best[-1][0]


def test_trie_counts_equal_brute_force(documents, texts):
    scores = piece_scores(Pieces(model_path()))
    words = sorted({"▁" + w for t in list(texts.values())[:30] for w in t.split()})[:600]
    words += ["▁" + t for t in random_texts(200, 12)]
    counter = TrieCounter(scores)
    assert counter.count(words) == [brute_count(w, scores) for w in words]
    assert counter.nodes < sum(map(len, words)) * 0.7  # shared prefixes are worked out once
    rows = {r.doc_id: r for r in token_counts(documents).collect()}
    for i in sorted(texts)[:5]:
        parts = re.findall("▁+[^▁]*", "▁" + texts[i].replace(" ", "▁"))
        want = [brute_count(p, scores) for p in parts]
        assert rows[i].n_pretokens == len(parts) and rows[i].n_tokens == sum(w[0] for w in want)
        assert math.isclose(rows[i].score, sum(w[1] for w in want) / 1e6, rel_tol=1e-9)


# Packing


def test_packing_round_trip(documents, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.pack_documents(documents).collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by[i], key=lambda r: r.piece):
            part = np.array(ids[at : at + r.length], "<u4")
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(part.tobytes()))
            assert r.length == 2048 or r.piece == 0
            at += r.length
        assert at == len(ids)
    fill: dict[int, list] = {}
    for r in rows:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r.length for r in rows) // 2048)
    assert least <= len(fill) <= least + 2


def test_fast_encoding_equals_the_library(tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    encode = packing._encoder(packing.tokenizer_path())
    odd = ["", "it's don't  'll ok", "<|endoftext|> in <|endoftext|>x", "é è\x85 q \x1c w", " \n\n a"]
    odd += [" " * 200_000 + "x", "\n" * 150_000, "!?" * 9000, "ab" * 9000, "漢字😀" * 500, "x<|endoftext|>\x00"]
    for text in odd + random_texts(400, 60, " \n\tab'1.é \xa0"):
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
    # A file of another shape is left to the library.
    import json

    parts = json.loads(Path(packing.tokenizer_path()).read_text())
    parts["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(parts))
    other = packing._encoder(str(tmp_path / "other.json"))
    assert other("word") == Tokenizer.from_file(str(tmp_path / "other.json")).encode("word").ids


@pytest.mark.parametrize("low, high", [(1, 2048), (500, 900), (1, 300)])
def test_local_search_never_loses(low, high):
    rng = random.Random(low)
    sizes = [rng.randint(low, high) for _ in range(1500)]
    bins = packing.Bins(sizes, 2048)
    before, squares = len(bins.items), sum(f * f for f in bins.fill)
    bins.improve()
    assert sum(bool(x) for x in bins.items) <= before
    assert sum(f * f for f in bins.fill) >= squares and max(bins.fill) <= 2048
    assert sorted(x for b in bins.items for x in b) == list(range(1500))
    assert all(sum(sizes[x] for x in b) == f for b, f in zip(bins.items, bins.fill, strict=True))


# Quality rules


def test_rule_counts_equal_brute_force(spark, texts):
    rows = list(texts.items()) + list(enumerate(random_texts(300, 60, "ab \n#|!A"), 10_000))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in quality_rules.rule_counts(df).collect()}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        places = {
            p for k, w in enumerate(windows) if windows.count(w) > 1 for p in range(k, k + 3)
        } if len(set(windows)) < len(windows) else set()
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(places),
        )
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want


def test_binomial_tail_is_exact(spark):
    cases = [(n, x) for n in (1, 10, 700, 3000) for x in (0, 1, 5, 20) if x <= n]
    df = spark.createDataFrame(cases, "n bigint, x bigint")
    tail = quality_rules.binomial_tail(F.col("n"), F.col("x"), 0.01)
    for r in df.withColumn("p", tail).collect():
        if r.x >= r.n * 0.01:
            assert r.p == 1.0
            continue
        a = Fraction(1, 100)
        want = sum(math.comb(r.n, k) * a**k * (1 - a) ** (r.n - k) for k in range(r.x + 1))
        assert math.isclose(r.p, float(want), rel_tol=1e-9)


def test_certified_rules_spare_the_good(spark):
    """3000 good and 300 bad texts that differ by symbols: one rule, few good ones lost."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(3300):
        bad = i % 11 == 0
        words = [f"w{rng.randrange(5000)}" + ("###" if bad else "#" * (rng.random() < 0.02)) for _ in range(60)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality_rules.apply_quality_rules(docs, marks).collect()}
    assert all(not got[i].kept and got[i].failed == ["symbols_per_word"] for i in range(0, 3300, 11))
    lost = sum(not got[i].kept for i in range(3300) if i % 11)
    assert lost <= 3000 * quality_rules.RISK
    few = quality_rules.apply_quality_rules(docs, marks.where("doc_id < 200")).collect()
    assert all(r.kept for r in few)  # too few labels certify nothing


# Personal data


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    out = [("email", *m.span()) for m in re.finditer(email, text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p.lstrip("0")[:4] or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m)):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m)) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_fixed_patterns_equal_brute_force(texts):
    some = random_texts(4000, 40, "a1.@ +-()0", 3) + random_texts(500, 60, "0123456789 -", 4)
    for text in [*some, *texts.values(), "x" * 50_000 + "@", "1" * 50_000 + ".", "1 " * 9000,
                 "0" * 5000 + ".1.1.1", "x 1.2." + "0" * 6000 + "255.0", "7" * 5000 + ".1.1.1"]:
        assert pii.base_spans(text) == brute_spans(text)


def test_field_finds_rewritten_data(texts):
    rng = random.Random(2)
    parts = [w for i, t in texts.items() for w in pii.training_windows(t, i)]
    made = ["mail ann{}.lee@mail{}.example.com now", "call +1 (988) 555-{:04d} today",
            "host 10.20.{}.7 is up", "card 4111111111111111 is {}"]
    for i in range(160):
        text = f"alpha beta {rng.choice('xyz')}. " + made[i % 4].format(i, i % 9) + " and more words"
        parts += pii.training_windows(text, i)
    rng.shuffle(parts)
    weights = pii.train(parts[: len(parts) * 2 // 3])
    hit = miss = false = 0
    for part, gold in parts[len(parts) * 2 // 3 :]:
        new = {tuple(g) for g in gold} - set(pii.base_spans(part))
        found = set(pii.find_spans(part, weights)[1])
        hit, miss, false = hit + len(new & found), miss + len(new - found), false + len(found - new)
    assert hit > 20 and hit / (hit + miss) > 0.85 and false <= 0.1 * hit


def test_field_finds_addresses_without_digits(texts):
    """Each rewritten form of an address that holds no digit, in a text without any."""
    parts = []
    rng = random.Random(4)
    name = lambda: "".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(3, 8)))
    for i in range(150):
        text = f"alpha beta {name()}. mail {name()}.{name()}@{name()}.com now and more words"
        parts += pii.training_windows(text, i)
    parts += [w for i, t in texts.items() for w in pii.training_windows(t, i)]
    weights = pii.train(parts)
    forms = [(" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "),
             ("(at)", "."), ("[at]", "[.]"), (" (at) ", ".")]
    for at, dot in forms:
        address = f"jane.roe{at}example{dot}com"
        text = f"please mail {address} about the house"
        want = ("email", 12, 12 + len(address))
        assert pii.find_spans(text, weights)[1] == [want], address
    # Windows open at a spaced at as well; without such a sign none does.
    assert pii.windows("jane at example.com is one", []) and not pii.windows("look at the house.", [])
    assert pii.find_spans("we met at the house (at noon) and left.", weights) == ([], [])


def segmentations(part, weights):
    """Every set of segments that do not overlap, with its score, segment by segment."""
    tokens = pii._tokens(part)
    none = (0.0,) * len(pii.KINDS)
    found = [
        (i, j, kind, sum(weights.get(x, none)[k] for x in (pii._CONSTANT, *slots)))
        for i, j, slots in pii.candidates(part, tokens) for k, kind in enumerate(pii.KINDS)
    ]

    def rest(at):
        yield 0.0, []
        for i, j, kind, s in found:
            if i >= at:
                for total, more in rest(j):
                    yield s + total, [(kind, tokens[i][0], tokens[j - 1][1]), *more]

    return rest(0)


def test_segmentation_equals_all_segmentations():
    rng = random.Random(8)
    several = 0
    for part in random_texts(120, 9, "1a2@. +-", 6) + ["at 10 dot 20", "+1 23 45", "a@b.c 12", "1 2 3"]:
        weights = {pii._CONSTANT: tuple(rng.uniform(-2, 1) for _ in pii.KINDS)}
        for _, _, slots in pii.candidates(part, pii._tokens(part)):
            for x in slots:
                weights.setdefault(x, tuple(rng.uniform(-1, 1) for _ in pii.KINDS))
        ranked = sorted(segmentations(part, weights), reverse=True)
        found = pii.decode(part, weights)
        assert [f[:3] for f in found] == ranked[0][1] or ranked[0][0] - ranked[1][0] < 1e-9
        assert sum(f[3] for f in found) == pytest.approx(ranked[0][0])
        several += len(found) > 1
    assert several > 5


def test_probabilities_equal_all_segmentations():
    """Forward and backward sums beside the sum over every segmentation."""
    rng = random.Random(9)
    for part in [*random_texts(40, 8, "1a2@. +-", 7), "+1 23 45", "a@b.c 12"]:
        weights = {pii._CONSTANT: tuple(rng.uniform(-2, 1) for _ in pii.KINDS)}
        found = list(pii.candidates(part, pii._tokens(part)))
        for _, _, slots in found:
            for x in slots:
                weights.setdefault(x, tuple(rng.uniform(-1, 1) for _ in pii.KINDS))
        if not found:
            continue
        window = pii._Window(part, set())
        scores = np.array([
            [sum(weights[x][k] for x in (pii._CONSTANT, *slots)) for k in range(len(pii.KINDS))]
            for _, _, slots in found
        ])
        shares, log = pii._shares(window, scores)
        every = [(np.exp(s), segments) for s, segments in segmentations(part, weights)]
        total = sum(p for p, _ in every)
        assert log == pytest.approx(np.log(total))
        tokens = pii._tokens(part)
        for row, (i, j, _) in zip(shares, found, strict=True):
            for k, kind in enumerate(pii.KINDS):
                segment = (kind, tokens[i][0], tokens[j - 1][1])
                want = sum(p for p, segments in every if segment in segments) / total
                assert row[k] == pytest.approx(want)


def test_field_of_all_windows(spark, monkeypatch):
    """Shards that no task order changes; copies of a text teach nothing more; long tables are decoded."""
    names = [f"t{i % 7}.x{i % 11}@mail{i}.example.com" for i in range(90)]
    rows = [(i, f"we write to {x} or call +1 (988) 555-{i:04d} then") for i, x in enumerate(names)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(pii, "SHARD", 100)
    weights = pii.fit_field(docs)
    assert len(weights) > 50 and all(len(w) == len(pii.KINDS) for w in weights.values())
    again = pii.fit_field(docs.union(docs.where("doc_id < 30")).repartition(7))
    assert again.keys() == weights.keys()
    for slot, row in weights.items():
        assert again[slot] == pytest.approx(row, abs=2e-6)
    address = "t3.x4 (at) mail7 (dot) example (dot) com"
    found = pii.find_spans(f"we write to {address} about it", weights)[1]
    assert found == [("email", 12, 12 + len(address))]
    assert pii.fit_field(spark.createDataFrame([(1, "in 1234 and 567")], docs.schema)) == {}
    base, _ = pii.find_spans("12 7\t" * 3000, weights)
    assert base == []


def test_spans_keep_the_fixed_ones(documents, texts):
    for r in pii.digest_personal_data(documents).collect():
        want = brute_spans(texts[r.doc_id])
        line = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(line).encode()).hexdigest()
        assert set(line) <= set(r.spans.split(",")) or not line
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(w[0] == k for w in want) for k in pii.KINDS
        ]


def test_masking_overlaps():
    spans = [("phone", 2, 9), ("ip", 4, 6), ("card", 8, 11)]
    assert pii.masked("ab1234567890cd", spans) == "ab[PHONE]0cd"


# Classifiers


def labelled_rows(n=900, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("rn", "st", "ll", "mp")]
    insults = ["zoggle", "blarpish", "vexnut"]
    rows, labels = [], []
    for i in range(n):
        toxic, bad = rng.random() < 0.3, rng.random() < 0.3
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 90))]
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(insults) + rng.choice(["", ",", "!"])
        text = " | ".join(words) if bad else " ".join(words)
        rows.append((i, text))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


def held_out_accuracy(score, column, spark):
    rows, labels = labelled_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r.score for r in score(texts_of(docs), marks, fold_of("doc_id", 3) != 1).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    truth = {r[0]: r[1 if column == "quality" else 2] for r in labels}
    assert len(held) > 200
    return sum((got[i] >= 0.5) == truth[i] for i in held) / len(held)


def test_toxicity_on_held_out_rows(spark):
    assert held_out_accuracy(toxicity.score_toxicity, "toxic", spark) > 0.97


def test_quality_on_held_out_rows(spark):
    assert held_out_accuracy(score_quality, "quality", spark) > 0.97


def test_label_model_weighs_voters():
    """Two voters that copy each other count less than their number; a random one not at all."""
    rng = random.Random(1)
    counts: dict[tuple[str, int], int] = {}
    for _ in range(20_000):
        y = rng.random() < 0.2
        one = y if rng.random() < 0.9 else not y
        three = y if rng.random() < 0.85 else not y
        vote = "".join(str(int(v)) for v in (one, one, rng.random() < 0.5, three))
        key = (vote + "2222", int(y) if rng.random() < 0.05 else -1)
        counts[key] = counts.get(key, 0) + 1
    post = toxicity.label_model([(v, y, n) for (v, y), n in sorted(counts.items())], 0.2)
    assert post["11112222"] > 0.85 > 0.15 > post["00002222"]
    assert abs(post["11012222"] - post["11112222"]) < 0.1
    assert 0.05 < post["11002222"] < 0.7


# Language model


def test_mixing_beats_word_counts_on_held_out_texts(documents, texts):
    rows = mixing.score_texts(documents, fold_of("doc_id", 7) != 2).collect()
    counts: dict[bytes, int] = {}
    words = {
        i: [*re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()), b""] for i, t in texts.items()
    }
    for i, w in words.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for x in w:
                counts[x] = counts.get(x, 0) + 1
    n, v = sum(counts.values()), len(counts)
    model = base = 0.0
    for r in rows:
        want = sum(math.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in words[r.doc_id])
        assert math.isclose(r.base_score, want, rel_tol=1e-9)
        assert (r.n_tokens, r.train_tokens) == (len(words[r.doc_id]), n)
        assert r.n_known == sum(x in counts for x in words[r.doc_id])
        assert r.score < 0
        if zlib.crc32(str(r.doc_id).encode()) % 7 == 2:
            model, base = model + r.score, base + r.base_score
    assert model > base


def test_letters_are_a_code():
    """Bits of all words of two letters or less sum to at most one under any counts."""
    words = [b"\x00" + w for w in (b"ab", b"abc", b"b", b"ba", b"abab")]
    tables = {o: np.zeros((1 << b, 2), np.uint16) for o, b in mixing.ORDERS.items()}
    bits = mixing._bits(words)
    next(bits)
    for _, bit, slots in bits:
        for o, s in slots.items():
            np.add.at(tables[o], (s, bit), 1)
    mixer = mixing.Mixer(tables)
    mixer.learn(words * 20)
    mixer.freeze()
    every = [b"\x00"] + [b"\x00" + bytes([x]) for x in range(256) if x != 32]
    every += [b"\x00" + bytes([x, y]) for x in range(256) if x != 32 for y in range(256) if y != 32]
    total = (10 ** mixer.score(every)).sum()
    assert 0.05 < total <= 1.0 + 1e-6


def test_repeats_foretell():
    ids = np.array([1, 2, 3, 4, 1, 2, 3, 4, 1, 2, 9])
    text = np.zeros(len(ids), int)
    state2, hit2, state1, hit1 = mixing.repeats(ids, text)
    assert hit2.tolist() == [False] * 6 + [True] * 4 + [False]
    assert hit1[5] and state2[6] == 1 and state2[9] > state2[6] and state2[10] > 0
    weight, own = mixing.own_shares(ids, text)
    assert weight[0] == 0 and (own[:4] == 0).all() and own[5] > 0 and (own <= weight).all()


def test_terms_are_found_wherever_they_are_mined():
    """After any sign that is no letter, in words of any length, and nowhere else."""
    long = "x" * 30
    words = ["grob", long, "überall", "grober", "gr", "1grob"]
    around = ["{}", "\u201c{}\u201d", "a\u2014{}\u2014b", "b\u00a0{}\u00a0c", "7{}", "\n{}\t", "²{}", "a{}", "_{}_"]
    texts = [a.format(w) for a in around for w in words] + ["", "grob grob"]
    terms = [(t, 0.99) for t in ("grob$", "grob", long + "$", "übe", "überall$", "gro")]
    hits = toxicity.look(texts, toxicity.finder(terms))[0]
    for text, found in zip(texts, hits, strict=True):
        assert {terms[k][0] for k in found} == toxicity.terms_of(text) & {t for t, _ in terms}, text
    assert toxicity.look(["grob grob"], toxicity.finder(terms))[1] == [[2, 2]]
    assert toxicity.look(["any"], toxicity.finder([]))[0] == [[]]
