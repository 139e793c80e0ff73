"""The ten operators against plain versions, on fixtures with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import itertools
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridmart.llm import decontaminate, jaccard, licenses, line_dedup, packing, pii, quality_rules, sentence_dedup, sharding, weak_quality

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Extra columns named like things the operators use.
SCHEMA = "doc_id long, text string, lang string, node string, h1 long, n long, shard string, kept string, spans string, start string, pos int, __n int"
PROSE = "the quick brown fox jumps over a lazy dog while seven small birds sing in old trees near quiet water under warm evening light".split()


def prose(seed, words=120):
    r = random.Random(seed)
    out = []
    while len(out) < words:
        sentence = [r.choice(PROSE) + r.choice(["", "", "", "ing", "er", str(r.randint(0, 999))]) for _ in range(r.randint(5, 14))]
        out += [sentence[0].capitalize(), *sentence[1:-1], sentence[-1] + "."]
    return " ".join(out)


def rows_of(texts, first=1):
    return [(first + i, t, "en", "x", 1, 2, "s", "k", "sp", "st", 3, 4) for i, t in enumerate(texts)]


@pytest.fixture
def docs(spark):
    return lambda texts, extra=(): spark.createDataFrame([*rows_of(texts), *extra], SCHEMA).repartition(3)


ODD = [None, "", " ", "\n", "\n\n\n", "a", "Ü ñ 漢字 words", "x\u0000y", "tab\there\r\n", "word " * 3000, "é" * 5000, "1" * 3000, "no end " + "@" * 50, "+" * 400]
NO_ID = (None, "a text without an id, which stands alone here", None, None, None, None, None, None, None, None, None, None)

OPERATORS = {
    "line_dedup": line_dedup.line_dedup,
    "license_scan": licenses.license_scan,
    "substring_dedup": sentence_dedup.substring_dedup,
    "pack": lambda d: packing.pack(d, TOKENIZER),
    "weak_quality": weak_quality.weak_quality,
    "similar_documents": jaccard.similar_documents,
    "leaks": lambda d: decontaminate.leaks(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    "quality_rules": quality_rules.quality_rules,
    "personal_data": lambda d: pii.personal_data(d, sample=20, cases=300),
    "balanced_shards": lambda d: sharding.balanced_shards(d, shards=4),
}
PER_ROW = {"line_dedup", "license_scan", "substring_dedup", "weak_quality", "quality_rules", "personal_data", "balanced_shards"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(docs, name):
    repeated = rows_of([prose(1)], first=500) * 3
    data = docs([*ODD, *ODD], [NO_ID, NO_ID, *repeated, *rows_of(["same id, other text"], first=500)])
    out = OPERATORS[name](data).collect()
    if name in PER_ROW:
        assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in data.collect())
    if name == "similar_documents":
        assert len(out) == data.select("doc_id", "text").distinct().count()
    if name == "pack":
        assert {r.doc_id for r in out} == {r.doc_id for r in data.collect()}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    out = OPERATORS[name](docs(["a"]).where("doc_id < 0"))
    assert out.count() == 0 and "doc_id" in out.columns


@pytest.mark.parametrize("name", ["line_dedup", "license_scan", "substring_dedup", "weak_quality", "quality_rules", "personal_data"])
def test_other_columns_pass(docs, name):
    out = OPERATORS[name](docs([prose(1), prose(2)]))
    assert {r.lang for r in out.collect()} == {"en"} and len(out.columns) == len({c.lower() for c in out.columns})


def plain_line_dedup(texts, least, keep):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    split = {i: (t or "").split("\n") for i, t in texts.items()}
    holders = defaultdict(set)
    for i, lines in split.items():
        for line in lines:
            holders[key(line)].add(i)
    out, seen = {}, set()
    for i in sorted(split):
        kept = []
        for line in split[i]:
            k = key(line)
            if not k or len(holders[k]) < least or (keep == "first" and k not in seen):
                kept.append(line)
            seen.add(k)
        out[i] = "\n".join(kept)
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("partitions", ["1", "7"])
def test_line_dedup(spark, docs, keep, partitions):
    r = random.Random(3)
    common = [f"Line number {i}" for i in range(12)]
    texts = {i: "\n".join(r.choice([" ", "", "\t"]) + r.choice([c, c.upper(), f"own {i} {r.random()}"]) for c in r.sample(common, 5)) for i in range(1, 150)}
    texts |= {200: None, 201: "", 202: "hot\nhot\nHOT"} | {300 + i: f"hot\nowned {i}" for i in range(200)}
    data = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = line_dedup.line_dedup(data, min_docs=10, keep=keep).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r.doc_id: r.text for r in got} == plain_line_dedup(texts, 10, keep)
    for row in got:
        if row.keep_bitmap is not None:
            mask = line_dedup.unpack(bytes(row.keep_bitmap), row.n_lines)
            assert (~mask).sum() == row.n_dropped


def test_stream_resolves_keys_cut_by_ranges(docs):
    """Ranges of one or two lines each: every key is open at both ends of several of them."""
    texts = {i: "shared\nother" for i in range(40)}
    data = docs([texts[i] for i in range(40)])
    hashes = line_dedup.line_hashes(data)
    assert hashes.count() == 80 and hashes.where("counted").count() == 80
    out = data.sparkSession.createDataFrame(hashes.collect(), hashes.schema).repartitionByRange(40, *line_dedup._LINE).sortWithinPartitions(*line_dedup._LINE)
    streamed = out.mapInArrow(line_dedup._streamed(10, False), line_dedup._STREAM).collect()
    assert not [r for r in streamed if r.kind == line_dedup._DROP]
    assert sum(r.n for r in streamed if r.kind == line_dedup._PART) == 80


LICENSE_TEXTS = [
    "Released under the MIT License.", "under the MIT license under the mit license", "Licensed under the Apache License, Version 2.0.", "CC-BY-NC 4.0", "cc by nc cc by nc",
    "This work is licensed under the GNU General Public License, version 3.", "permission is granted", "under the mit licence", None, "",
]


def test_license_base(docs):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    data = docs(LICENSE_TEXTS)
    got = {r.doc_id: r for r in licenses.license_scan(data).collect()}
    for i, text in enumerate(LICENSE_TEXTS, 1):
        words = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        places = [(k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        starts = [k for k, _ in places]
        row = got[i]
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (len(words), len(starts), min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1


@pytest.mark.parametrize("text, length", [("one two five", 3), ("one three five", -1), ("one two x y five", 5), ("one two x y z five", -1), ("one two four four five", 5), ("one two x five six", 4)])
def test_automaton(text, length):
    automaton = licenses.Automaton.compile("one two <<beginOptional>><<var;match=1..2>><<endOptional>> five")
    assert automaton.match(text.encode().split(), 0) == length


def test_automaton_agrees_with_enumeration():
    """All texts of up to five words over a small alphabet, against an expansion of the template."""
    template = "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;match=0..2>> d"
    automaton = licenses.Automaton.compile(template)
    pattern = re.compile(r"a(b(c)?)?.{0,2}?d")
    for n in range(1, 6):
        for text in itertools.product("abcd", repeat=n):
            ends = [k for k in range(1, n + 1) if re.fullmatch(r"a(b(c)?)?.{0,2}d", "".join(text[:k]))]
            assert automaton.match([w.encode() for w in text], 0) == max(ends, default=-1), (text, pattern)


def _said(template):
    """A text that a template accepts: optional regions left in, three words in place of each replaceable one."""
    import re

    return re.sub(r"<<(begin|end)Optional>>", " ", re.sub(r"<<var;match=\d+\.\.\d+>>", "some three words", template))


@pytest.mark.parametrize("label", ["mit-text", "bsd-2-clause-text", "isc-text"])
def test_whole_license_texts(docs, label):
    """All of the mandatory wording has to stand: without its disclaimer, or with a word of it changed, a text is not accepted."""
    whole = _said(licenses.TEMPLATES[label])
    cut = whole[: whole.lower().rindex("provided")]
    texts = [whole, f"before {whole.upper()} after", cut, whole.replace("in no event", "in any event").replace("In no event", "In any event")]
    got = {r.doc_id: r.labels.split(",") for r in licenses.license_scan(docs(texts)).collect()}
    assert [label in got[i] for i in (1, 2, 3, 4)] == [True, True, False, False]


def test_templates_from_files(spark, docs, tmp_path):
    (tmp_path / "house-1.0.txt").write_text("may be used <<beginOptional>>freely<<endOptional>> by\n<<var;match=1..2>> alone")
    templates = licenses.read_templates(spark, str(tmp_path))
    texts = ["It may be used by our friends alone.", "may be used by many more people alone"]
    got = {r.doc_id: r.labels for r in licenses.license_scan(docs(texts), templates=templates).collect()}
    assert list(templates) == ["house-1.0"] and got == {1: "house-1.0", 2: ""}


def plain_spans(texts, least_sentences, least_words):
    runs = defaultdict(list)
    for i, text in sorted(texts.items()):
        ends, folded, counts = sentence_dedup.sentences(text or "")
        starts = [0, *ends[:-1]]
        worded = [k for k, n in enumerate(counts) if n]
        for a in range(len(worded)):
            for b in range(a, len(worded)):
                own = worded[a : b + 1]
                if len(own) >= least_sentences and sum(counts[k] for k in own) >= least_words:
                    runs[tuple(folded[k] for k in own)].append((i, starts[own[0]], ends[own[-1]]))
    gone = defaultdict(set)
    for places in runs.values():
        for i, a, b in sorted(places)[1:]:
            gone[i] |= set(range(a, b))
    return gone


def test_substring_dedup(docs):
    r = random.Random(5)
    passages = [prose(f"p{i}", 60) for i in range(6)]
    texts = [" ".join(x for k in range(3) for x in (prose(f"{i}/{k}", 30), r.choice(passages) if r.random() < 0.4 else "")) for i in range(60)] + [None, "", "short", "long " * 400]
    texts.append(texts[0])
    data = docs(texts)
    gone = plain_spans(dict(enumerate(texts, 1)), 2, 24)
    assert gone
    for row in sentence_dedup.substring_dedup(data).collect():
        text = texts[row.doc_id - 1]
        want = text if text is None else "".join(c for k, c in enumerate(text) if k not in gone[row.doc_id])
        assert row.text == want


def all_spans(texts, least_sentences, least_words):
    """Like ``plain_spans``, of every run there is and not only the shortest from each sentence."""
    runs = defaultdict(list)
    for i, text in sorted(texts.items()):
        ends, folded, counts = sentence_dedup.sentences(text or "")
        starts = [0, *ends[:-1]]
        worded = [k for k, n in enumerate(counts) if n]
        for a, b in itertools.combinations(range(len(worded) + 1), 2):
            own = worded[a:b]
            if len(own) >= least_sentences and sum(counts[k] for k in own) >= least_words:
                runs[hash(tuple(folded[k] for k in own))].append((i, starts[own[0]], ends[own[-1]]))
    gone = defaultdict(set)
    for places in runs.values():
        for i, a, b in sorted(places)[1:]:
            gone[i] |= set(range(a, b))
    return gone


def test_a_null_id_stays_null(spark):
    """Documents without an id and with id 0 are told apart, as later copies and as first places."""
    passage = prose("p", 60)
    rows = [(None, f"{prose(1, 30)} {passage}"), (0, f"{prose(2, 30)} {passage}"), (5, f"{prose(3, 30)} {passage}")]
    spans = sentence_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    key = [F.col(c) for c in ("__row_id", "__row_hash")]
    got = {(r.id, r.first_doc_id) for r in spans.select(sentence_dedup.known_id(*key).alias("id"), "first_doc_id").collect()}
    assert got in ({(0, None), (5, None)}, {(None, 0), (5, 0)})
    alone = sentence_dedup.repeated_spans(spark.createDataFrame([(None, rows[0][1]), (None, rows[1][1])], "doc_id long, text string"))
    assert {(r.id, r.first_doc_id) for r in alone.select(sentence_dedup.known_id(*key).alias("id"), "first_doc_id").collect()} == {(None, None)}


def test_every_sentence_of_a_repeated_span_is_cut(docs):
    r = random.Random(6)
    sentence = lambda n: " ".join(r.choice(PROSE) + str(r.randrange(999)) for _ in range(n)).capitalize() + "."
    passages = [" ".join(map(sentence, sizes)) for sizes in ((30, 10, 10), (10, 10, 30), (5, 20, 3, 2), (23, 1), (12, 12, 11, 12))]
    texts = [" ".join([sentence(28), x, sentence(28), r.choice(passages), sentence(5)]) for x in passages for _ in range(3)]
    texts += ["One. " * 60, "", None]
    gone = all_spans(dict(enumerate(texts, 1)), 2, 24)
    assert all(any(len(gone[i]) >= len(x) for i in range(3 * k + 1, 3 * k + 4)) for k, x in enumerate(passages))
    for row in sentence_dedup.substring_dedup(docs(texts)).collect():
        text = texts[row.doc_id - 1]
        assert row.text == (text if text is None else "".join(c for k, c in enumerate(text) if k not in gone[row.doc_id]))


def test_runs_of_a_passage_inside_long_sentences():
    """A passage without a sentence mark gives equal runs at every offset in the sentence around it."""
    r = random.Random(1)
    for n in range(20):
        passage = " ".join(f"w{r.randrange(400)}" for _ in range(51))
        around = lambda side, k: " ".join(f"{side}{n}x{i}" for i in range(k))
        hashes = [set(sentence_dedup.runs(f"{around(f'b{o}', 40 + o)} {passage} {around(f'a{o}', 40)}", 2, 24)[0].tolist()) for o in range(16)]
        assert all(hashes[0] & h for h in hashes[1:])


def test_sentences_cover_the_text():
    for text in [prose(1), "a\n\n b.  c! d", "w " * 100, "...", " lead. end ", "one.two\nthree?\" four"]:
        ends, _, _ = sentence_dedup.sentences(text)
        assert ends == sorted(set(ends)) and ends[-1] == len(text)


SPECIAL = [
    "plain text, with punctuation.", "  two  spaces ", "line\nbreak\n\n twice", "a <|endoftext|> b", "", None, "it's we'll 123 45", "ünïcode 漢字 🙂 x", " nbsp wide",
    "trailing ", " leading", "x" * 9000, "a\tb \t c", "\u001cfs\u001c a",
]


def test_pack(docs):
    texts = [*SPECIAL, *(prose(i, 40 * i) for i in range(1, 30))]
    reference = Tokenizer.from_file(TOKENIZER)
    got = defaultdict(list)
    rows = packing.pack(docs(texts), TOKENIZER, longest=256).collect()
    for r in rows:
        got[r.doc_id].append(r)
    for i, text in enumerate(texts, 1):
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted(got[i], key=lambda r: r.start)
        assert b"".join(bytes(p.tokens) for p in pieces) == ids.tobytes()
        at = 0
        for p in pieces:
            assert p.start == at and p.length & (p.length - 1) == 0 and p.length <= 256 and p.doc_tokens == len(ids) and p.offset == 0
            assert p.ids_crc32 == zlib.crc32(bytes(p.tokens))
            at += p.length
        assert len(pieces) == len(ids) // 256 + bin(len(ids) % 256).count("1")
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    in_order = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert in_order == sorted(in_order, reverse=True)


def test_binary_pieces():
    for n in range(300):
        pieces = packing.binary_pieces(n, 64)
        assert sum(k for _, k in pieces) == n and all(k & (k - 1) == 0 and k <= 64 for _, k in pieces)


def plain_links(texts, n, threshold):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    sets = {}
    for i, t in texts.items():
        w = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        if w:
            sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


@pytest.mark.parametrize("block", [2, 256])
def test_similar_documents(docs, monkeypatch, block):
    """Groups larger than a block are cut, and still lose and repeat nothing."""
    monkeypatch.setattr(jaccard, "BLOCK_NODES", block)
    r = random.Random(11)
    texts = []
    for group in range(25):
        base = prose(f"g{group}", 120).split()
        for _ in range(r.choice([1, 1, 2, 3, 8])):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 6])):
                words[r.randrange(len(words))] = f"changed{r.randint(0, 9)}"
            texts.append(" ".join(words))
    texts += ["Few words", "few words!", None, ""]
    links = plain_links(dict(enumerate(texts, 1)), 5, Fraction(4, 5))
    label = {i: i for i in range(1, len(texts) + 1)}
    for _ in range(len(texts)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    degree = Counter(x for pair in links for x in pair)
    got = jaccard.similar_documents(docs(texts)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {i: (label[i], degree[i]) for i in label}
    assert sorted(r.doc_id for r in got if r.is_first) == sorted(set(label.values()))
    if block == 256:
        assert sorted(r.doc_id for r in jaccard.first_of_each(docs(texts * 1)).collect()) == sorted(set(label.values()))


def test_components_of_a_chain(spark):
    from gridmart.llm.components import components

    edges = [(f"{i:03d}".encode(), f"{i + 1:03d}".encode()) for i in range(60)] + [(b"x1", b"x0"), (b"x1", b"x2")]
    got = {bytes(r.node): bytes(r.label) for r in components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert {got[f"{i:03d}".encode()] for i in range(61)} == {b"000"} and got[b"x2"] == got[b"x1"] == b"x0"


def test_chosen_bands_reach_the_recall():
    from gridmart.llm.shingles import choose_bands

    for recall in (0.9, 0.99, 0.999):
        bands = choose_bands(0.8, recall, 6)
        assert 1 - (1 - 0.8**6) ** bands >= recall > 1 - (1 - 0.8**6) ** (bands - 1)


QUESTION = "A farmer named Alice had 12 sheep and bought 30 more at the spring market, so how many sheep does Alice own today?"


def test_leaks(spark, docs):
    texts = [
        f"{prose(1, 60)} {QUESTION} {prose(2, 60)}",
        f"{prose(3, 60)} {QUESTION.replace('Alice', 'Boris').replace('12', '45').replace('30', '99')} {prose(4, 30)}",
        f"{prose(5, 60)} {QUESTION.replace('had 12', 'had 30').replace('named Alice', 'named Boris')}",
        QUESTION.upper(), prose(6, 300), None, "",
    ]
    benchmark = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (2, None), (None, prose(6, 300)), (3, "too short"), (4, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.kind) for r in decontaminate.leaks(docs(texts), benchmark).collect()}
    # The third text's two Alices became one Boris and one Alice: windows that contradict the rest are left out, the others count.
    assert {x for x in got if x[0] != 4} == {(1, 1, "verbatim"), (2, 1, "reparameterised"), (3, 1, "reparameterised")}


def test_leaks_with_small_edits_and_in_part(spark, docs):
    r = random.Random(8)
    words = lambda n: [f"{r.choice(PROSE)}{chr(97 + r.randrange(26))}{chr(97 + r.randrange(26))}" for _ in range(n)]
    item, long_item = words(45), words(200)
    texts = [
        " ".join([*words(30), *item[:15], "really", *item[15:30], "truly", *item[30:], *words(30)]),
        " ".join([*words(30), *item[:12], *item[13:24], "so", *item[24:34], *item[36:], *words(30)]),
        " ".join([*words(30), *long_item[70:130], *words(30)]),
        " ".join([*words(30), *long_item[70:100], *words(30)]),
    ]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(long_item))], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs(texts), benchmark).collect()} == {(1, 1), (2, 1), (3, 2)}


def test_leaks_leave_out_contradicting_windows_only(spark, docs):
    tail = "and then the merchant counted every coin twice before closing the heavy wooden door behind his guests"
    item = f"a farmer named Alice had 12 sheep and bought 30 more at the spring market {tail} while Alice slept near 12 barrels of cider"
    texts = [item.replace("near 12", "near 13"), item.replace("named Alice", "named Boris").replace("12", "40").replace("30", "50"), item.replace("12", "15").replace("30", "15")]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.leaks(docs([f"{prose(i, 40)} {t} {prose(i + 9, 40)}" for i, t in enumerate(texts)]), benchmark).collect()}
    assert {i: r.kind for i, r in got.items()} == {1: "verbatim", 2: "reparameterised", 3: "reparameterised"}
    assert got[1].cover < 1 and got[3].cover == 1


def test_leaks_of_items_without_telling_windows(spark, docs):
    items = ["Compute 12 + 30 * 4 - 7 / 2", "What is 12 times 7?", "Alice, Boris, Carol, Dora, Emil, Fritz, Greta, Hugo, Ivan and Jane", "1914 1918 1939 1945 1949 1953 1961 1989 1990", "again and again and again and again and again"]
    texts = [f"{prose(i, 40)} {item} {prose(i + 9, 40)}" for i, item in enumerate(items)] + [f"{prose(1, 40)} Compute 13 + 30 * 4 - 7 / 2 {prose(2, 40)} What is 12 times 8?", items[2].upper()]
    benchmark = spark.createDataFrame(list(enumerate(items, 1)), "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.kind) for r in decontaminate.leaks(docs(texts), benchmark).collect()}
    assert got == {(i, i, "verbatim") for i in range(1, 6)} | {(7, 3, "verbatim")}


def test_leaks_of_short_and_slot_rich_items(spark, docs):
    """A word that stands in all documents says nothing, and one phrase of an item of numbers is not the item."""
    numbers = " ".join(str(k * 7) for k in range(34))
    item = f"the quiet old heron stood below a wooden {numbers}"
    benchmark = spark.createDataFrame([(1, "Yes"), (2, item), (3, "What is 12 times 7?")], "item_id long, text string")
    texts = [f"{prose(i, 30)} yes {prose(i + 50, 30)}" for i in range(20)] + [f"{prose(1, 30)} the quiet old heron stood below a wooden bridge {prose(2, 30)}", f"{prose(3, 9)} {item} {prose(4, 9)}", f"{prose(5, 9)} What is 12 times 7?"]
    got = {(r.doc_id, r.item_id, r.kind) for r in decontaminate.leaks(docs(texts), benchmark).collect()}
    assert got == {(i, 1, "short") for i in range(1, 21)} | {(22, 2, "verbatim"), (23, 3, "verbatim")}
    many = decontaminate.leaks(docs([texts[-1] + f" {i}" for i in range(11)]), benchmark)
    assert {r.kind for r in many.collect()} == {"short"}


def plain_tokens(text):
    """Template words and slots of one text, word by word."""
    words, out, slots, before = decontaminate._Words(), [], [], None
    for word in text.encode().split():
        coded = words[word]
        if coded:
            flags, value = coded & 15, coded & ~15
            number, title, unit = flags & 1, flags & 2 and before is not None and not before & 4, flags & 8 and before is not None and before & 1
            out.append(11 if number else 17 if unit else 13 if title else value)
            slots.append(value | 16 if number or unit or title else 0)
            before = flags
    return out, slots


def test_windows_of_texts_scanned_together(spark, docs):
    """Texts of a batch share arrays; words, slots and windows are those of each text alone."""
    texts = [*[t or "" for t in ODD], prose(1, 300), "", QUESTION, "12 km. Alice 5 kg", "Alice", "kg 7", QUESTION.upper(), prose(2, 20)] * 3
    template, slots, owner = decontaminate.Templates().tokens([t.encode() for t in texts])
    want = [plain_tokens(t) for t in texts]
    assert template.tolist() == [x for w, _ in want for x in w] and slots.tolist() == [x for _, s in want for x in s]
    assert owner.tolist() == [i for i, (w, _) in enumerate(want) for _ in w]
    kinds = [(3, False), (3, True), (8, True)]
    full = {exact: np.full(decontaminate.BITS // 8, 255, np.uint8) for exact in (False, True)}
    rows = decontaminate._window_table(docs(texts), ["doc_id"], "doc_id long", kinds, full).collect()
    signed = lambda x: np.uint64(x).astype(np.int64).item()
    got = Counter((r.doc_id, r.pos, tuple(r.slots), r.exact) for r in rows)
    assert got == Counter((i + 1, p, tuple(map(signed, s[p : p + n])), e) for i, (w, s) in enumerate(want) for n, e in kinds for p in range(len(w) - n + 1))


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(docs):
    texts = [*ODD, prose(1), "again and again it says so.\n" * 9, " ".join(["w1 w2 w3 w4 w5 w6 w7 w8"] * 2 + ["tail"] * 30), "# a | b\n# a | b\n\n \nc", "one two " * 40 + prose(2)]
    rows = quality_rules.quality_rules(docs(texts)).collect()
    for r in rows:
        measures = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert measures == plain_quality(texts[r.doc_id - 1])
        assert r.base_failed == (measures[0] < 20 or 100 * measures[4] > 30 * measures[0])
        assert not (r.base_failed and r.kept)


def test_quality_lines_go_first(docs):
    clean = "\n".join(prose(i, 40) for i in range(4))
    mixed = f"{clean}\nhome | about | news | contact | shop\nAll rights reserved.\nno end here"
    junk = "home | about | news | contact | shop | help | login | cart | blog | jobs\n" * 1 + "\n".join(f"item{i} | {i} | price" for i in range(20))
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs([clean, mixed, junk])).collect()}
    assert got[1].kept and got[1].clean_text == clean and got[2].kept and got[2].clean_text == clean and got[2].n_lines_removed == 3 and not got[3].kept


SCRIPTS = {
    "latin": ("the quiet river carried old wooden boats past Anna and her brother towards green hills", "."),
    "cyrillic": ("тихая река несла старые лодки мимо Анны и её брата к зелёным холмам у дальней дороги", "?"),
    "devanagari": ("शांत नदी पुरानी नावों को हरी पहाड़ियों की ओर ले जाती थी और लोग किनारे पर बैठे थे", "।"),
    "arabic": ("كان النهر الهادئ يحمل القوارب القديمة نحو التلال الخضراء وكان الناس يجلسون على الضفة", "؟"),
}


@pytest.mark.parametrize("sentence", [15, 25, 40])
@pytest.mark.parametrize("script", SCRIPTS)
def test_wrapped_prose_loses_nothing(spark, tmp_path, script, sentence):
    """At 72 columns most lines hold no end of a sentence; the operator and its SQL agree."""
    words, mark = SCRIPTS[script]
    r = random.Random(sentence)
    text = " ".join(" ".join(r.choice(words.split()) + f"{r.choice(words)}".strip() for _ in range(sentence)).capitalize() + mark for _ in range(12))
    wrapped = "\n".join(textwrap.wrap(text, 72))
    junk = "\n".join(["Home page", "Our products and prices", "Contact and imprint", "Products A to Z"] * 6)
    rows = [(1, wrapped), (2, f"{wrapped}\n\n{wrapped}"), (3, f"{wrapped}\n{junk}"), (4, junk)]
    data = spark.createDataFrame([(i, t, "en", "x", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    got = {r.doc_id: r for r in quality_rules.quality_rules(data).collect()}
    assert got[1].clean_text == wrapped and got[1].n_lines_removed == 0
    assert got[3].clean_text == wrapped and got[3].n_lines_removed == 24 and not got[4].kept
    data.coalesce(1).write.parquet(f"{tmp_path}/documents")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    from gridmart.llm.queries import QUALITY_CTES

    assert dict(connection.sql(f"WITH {QUALITY_CTES} SELECT doc_id, clean FROM quality").fetchall()) == {i: r.clean_text for i, r in got.items()}


def test_native_plans(spark, plan):
    data = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (quality_rules.quality_rules(data).where("kept"), sharding.balanced_shards(data, shards=2)):
        text = plan(df)
        assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text


PII_TEXTS = [
    "mail a.b@c.example.org, or x@y or @z.com or q@w.e.", "hosts 10.0.0.255 1.2.3.4.5.6.7.8 300.1.1.1 1.2.3", "card 4539 1488 0343 6467 and 4539148803436468 12-34",
    "call +1 (555) 010-9999 or +12 or +44 20 7946 0958 ", "a@b.c@d.e", "..@a-b.c-d..", "0" * 16, "+1-2-3-4-5-6-7-8-9-", None, "", "é@é.com ñ 漢 a@b.co 9.9.9.9",
]


def test_pii_base():
    digits = lambda x: re.sub("[^0-9]", "", x)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda x: 13 <= len(digits(x)) <= 19 and pii.luhn(digits(x))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
    }
    r = random.Random(2)
    made = ["".join(r.choice("aZ09@.+- ()_%é") for _ in range(r.randint(1, 60))) for _ in range(3000)]
    for text in [t or "" for t in PII_TEXTS] + made:
        want = [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m[0])]
        assert pii.base_spans(text) == want, text


def test_pii_spans(docs):
    secret = "f3a9c1e07b5d4826a1c3e5f708192a3b4c5d6e7f"
    texts = [*PII_TEXTS, f'the token = "{secret}" ends', prose(1), "in 1999-05-12 there were 1,234,567 of them"]
    rows = {r.doc_id: r for r in pii.personal_data(docs(texts), sample=20, cases=3000).collect()}
    for i, text in enumerate(texts, 1):
        base = pii.base_spans(text or "")
        assert rows[i].base_spans == ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(rows[i].spans.split(",")) | {""}
    at = texts[len(PII_TEXTS)].index(secret)
    assert f"secret:{at}:{at + 40}" in rows[len(PII_TEXTS) + 1].spans.split(",")
    assert rows[len(texts)].spans == "" and rows[len(texts) - 1].spans == ""
    assert pii.redact("write to a@b.com now", "email:9:16") == "write to [email] now"


def test_pii_spelled_out_address_and_long_secret(docs):
    r = random.Random(4)
    secret = "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(900))
    address = "marina (at) aniram (dot) org"
    texts = [f"please write to {address} about the garden", f'the token = "{secret}" ends', *(" ".join(r.choices(PROSE, k=60)) for _ in range(20))]
    rows = {x.doc_id: x for x in pii.personal_data(docs(texts), sample=20, cases=3000).collect()}
    assert rows[1].spans == f"email:16:{16 + len(address)}" and rows[2].spans == f"secret:13:{13 + len(secret)}"
    assert not any(rows[i].spans for i in range(3, 23))


def test_pii_recall_and_false_spans():
    """Of planted spans of each kind, and of look-alikes, in carriers the model was not fitted in."""
    model = pii.fit_redactor([" ".join(random.Random(i).choices(PROSE, k=60)) for i in range(20)], cases=6000)
    rng, r = np.random.default_rng(99), random.Random(99)
    texts, planted = [], []
    for _ in range(3000):
        before = " ".join(r.choices(PROSE, k=10))
        inserted, _, kind, begin, end = pii._made_up(rng)
        texts.append(f"{before} {inserted} {' '.join(r.choices(PROSE, k=10))}")
        planted.append(kind and (kind, len(before) + 1 + begin, len(before) + 1 + end))
    found = model.spans(texts)
    covered = defaultdict(list)
    for want, spans in zip(planted, found):
        if want:
            covered[want[0]].append(any(a <= want[1] and b >= want[2] for _, a, b in spans))
    recall = {kind: np.mean(x) for kind, x in covered.items()}
    assert set(recall) == set(pii.KINDS) and min(recall.values()) >= 0.9, recall
    number = lambda: r.choice(["1998", "12,500", "3.5", "2/3", "No. 7", "2024-03-01", "17:45", "1,250,000"])
    plain = model.spans([" ".join(f"{' '.join(r.choices(PROSE, k=6))} {number()}" for _ in range(40)) for _ in range(500)])
    assert sum(map(bool, plain)) <= 0.02 * len(plain)
    assert np.mean([bool(spans) for want, spans in zip(planted, found) if not want]) <= 0.1


def test_boosted_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    from gridmart.llm.boosting import BoostedTrees, threshold_for

    trees = BoostedTrees().fit(x[:3000], y[:3000])
    scores = trees.predict(x[3000:])
    assert ((scores > 0.5) == y[3000:]).mean() > 0.95
    limit = threshold_for(scores, y[3000:], 0.98)
    assert y[3000:][scores >= limit].mean() >= 0.98


def test_weak_quality(docs):
    good = [prose(i, 150) for i in range(200)]
    bad = [" ".join(w + random.Random(i).choice(["%%%", "###", "&&&"]) for w in prose(i, 100).split()) for i in range(20)]
    bad += [prose(i, 100).upper() for i in range(20)] + [" ".join(w for w in prose(i, 20).split() for _ in range(6)) for i in range(20)]
    rows = weak_quality.weak_quality(docs(good + bad)).collect()
    right = sum(r.kept == (r.doc_id <= len(good)) for r in rows)
    assert right >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_weak_quality_is_repeatable_and_a_text_counts_once(spark, docs):
    """Rows in another order, in other partitions and with one text repeated until it fills two thirds of the table."""
    texts = [prose(i, 80) for i in range(120)] + [" ".join(w + "%%#" for w in prose(i, 60).split()) for i in range(30)]
    scores = []
    for data in (docs(texts), docs(texts).orderBy(F.rand(3)).repartition(11), docs(texts).orderBy(F.desc("doc_id")).coalesce(1)):
        scores.append({r.doc_id: (r.score, r.weak_label, r.kept) for r in weak_quality.weak_quality(data, sample=60).collect()})
    assert scores[0] == scores[1] == scores[2]
    flooded = docs(texts + [texts[0]] * 300)
    kept = {r.doc_id: r.kept for r in weak_quality.weak_quality(flooded, sample=60).collect()}
    assert sum(kept[i] == (i <= 120) for i in range(1, 151)) >= 145


def test_features_are_bounded(spark):
    made = spark.createDataFrame([(h, bytes(4 * 100), b"", 1.0) for h in range(-20, 20)], "h long, slots binary, weights binary, label double")
    assert sorted(r.h for r in weak_quality._chosen(made, 10, 10**6).collect()) == list(range(-20, -10))
    assert sorted(r.h for r in weak_quality._chosen(made, 30, 650).collect()) == list(range(-20, -14))
    assert weak_quality._chosen(made, 30, 5).count() == 0


def test_estimate_finds_the_faulty_heuristics():
    """Documents drawn from the model: the estimate finds how often each heuristic fires on bad ones."""
    rng = np.random.default_rng(4)
    fires = np.linspace(0.3, 0.7, 9)
    bad = rng.random(20_000) < 0.2
    cast = (rng.random((20_000, 9)) < np.where(bad[:, None], fires, 0.002)).astype(int)
    posterior, found = weak_quality.estimate(Counter(weak_quality.pattern(cast).tolist()))
    assert np.abs(found[0] - fires).max() < 0.05
    assert np.mean([(posterior[int(p)] < 0.5) == b for p, b in zip(weak_quality.pattern(cast), bad)]) > 0.97


@pytest.mark.parametrize("n, shards", [(401, 7), (3, 5)])
def test_balanced_shards(docs, n, shards):
    r = random.Random(n)
    texts = ["hot copy"] * (n // 3) + [f"group {i // 4}" for i in range(n // 3)]
    texts += [f"alone {i} {r.random()}" for i in range(n - len(texts))]
    rows = sharding.balanced_shards(docs(texts), shards=shards, bucket_rows=10).collect()
    sizes = Counter(x.shard for x in rows)
    assert len(rows) == n and max(sizes.values()) - min(sizes[j] for j in range(shards)) <= 1
    for shard in sizes:
        assert sorted(x.slot for x in rows if x.shard == shard) == list(range(sizes[shard]))
    for x in rows:
        text = (texts[x.doc_id - 1] or "").encode()
        assert (x["size"], x.text_crc32, x.law) == (len(text) + 16, zlib.crc32(text), "rows")
    if n > 100:
        groups = defaultdict(set)
        for x in rows:
            if texts[x.doc_id - 1].startswith("group"):
                groups[texts[x.doc_id - 1]].add(x.shard)
        assert sum(len(g) == 1 for g in groups.values()) >= 0.8 * len(groups)


def test_a_large_group_fills_few_shards(docs):
    """A third of the rows are one text: it ends in two shards more than would hold it, at most; groups of 200 stay nearly whole."""
    r = random.Random(3)
    texts = ["hot copy"] * 2000 + [f"group {i // 200}" for i in range(1600)] + [f"alone {i} {r.random()}" for i in range(2400)]
    rows = sharding.balanced_shards(docs(texts), shards=40).collect()
    where = defaultdict(Counter)
    for x in rows:
        where[texts[x.doc_id - 1]][x.shard] += 1
    least = -(-2000 // 150)
    assert len(where["hot copy"]) <= least + 2
    groups = [c for t, c in where.items() if t.startswith("group")]
    assert sum(max(c.values()) for c in groups) >= 0.4 * 1600
    assert max(Counter(x.shard for x in rows).values()) == 150


def test_query_digest_is_of_the_kept_text(spark):
    from gridmart.llm.queries import QUERIES

    digests = {r.doc_id: r.kept_sha256 for r in QUERIES["op1_line_dedup"](spark, "/root/testdata/sf0.001").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in plain_line_dedup(texts, 10, "none").items()}
    assert digests == want
