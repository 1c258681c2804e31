"""Operators against plain versions on small tables with awkward rows."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from llm import brute  # noqa: E402
from stayflow.llm import chat, decontaminate, language_id, mixing, quality_rules, secret_scan, simhash, suffix_dedup, token_counts, warc  # noqa: E402
from stayflow.llm.common import read_table  # noqa: E402
from stayflow.llm.queries import tokenizer_path  # noqa: E402
from stayflow.session import scratch_path  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "harbor quiet lantern meadow orchard pebble river silver thicket umbra velvet willow yonder zephyr amber birch cedar dune ember fjord".split()


def prose(seed, n):
    return " ".join(WORDS[(seed * 7 + i * i * 3 + i * seed) % len(WORDS)] + str((seed * 31 + i) % 97) for i in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and blank texts, a very long one, copies, near copies, repeated rows, odd characters."""
    shared = prose(1, 60)
    rows = [
        (1, shared, "en", "a", 10),
        (2, shared, "fr", "a", 10),
        (3, shared + " extra", "en", "b", 10),
        (4, None, "en", "a", None),
        (5, "", "en", None, 0),
        (6, " \t\r\n\x0b\x0c ", None, "c", 3),
        (7, prose(2, 30_000), "de", "c", None),
        (8, "\x00\x85  Éa ß  \U0001f600 x", "de", "", 9),
        (9, "ab" * 3_000, "es", None, None),
        (10, prose(3, 80) + "\n" + shared + "\n" + prose(4, 80), "en", "b", 1),
        (11, "A line of text\nA line of text\n\n " + prose(5, 70), "en", "a", 1),
        (11, "A line of text\nA line of text\n\n " + prose(5, 70), "en", "a", 1),
        (12, "the the the the the the " * 20, "en", "a", 1),
        (13, "one two", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def clashing(awkward):
    """The same documents with columns named like those the operators make."""
    names = ["size", "row", "match", "held", "fp", "component_id", "lang_pred", "score", "findings", "range", "bucket", "epochs", "part", "target", "key"]
    return awkward.selectExpr("*", *[f"doc_id as {n}" for n in names])


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_mix_meets_targets_and_repeats(spark, awkward):
    plan = mixing.mix_plan(awkward)
    got = plan.collect()
    sizes = {}
    for r in awkward.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.SPACED.findall(r.text or ""))
    want = brute.targets(sizes)
    assert len(got) == awkward.count()
    for source, target in want.items():
        of = [r for r in got if r.source == source]
        assert all(r.target == pytest.approx(target) and r.source_size == sizes[source] for r in of)
        assert sum(r.taken for r in of) == int(target + 1e-9)
    assert all(r.taken <= 2 * r["size"] for r in got)
    assert rows(plan, "doc_id", "taken") == rows(mixing.mix_plan(awkward.repartition(5)), "doc_id", "taken")


def test_mix_writes_what_the_plan_takes(spark, awkward, clashing, nothing):
    mixed = mixing.mix(clashing)
    assert mixed.columns == [*clashing.columns, "epoch"]
    taken = sum(len(brute.SPACED.findall(r.text or "")) for r in mixed.collect())
    assert taken == sum(r.taken for r in mixing.mix_plan(awkward).collect())
    assert mixing.mix(nothing).count() == 0 and mixing.mix_plan(nothing).count() == 0


def test_level_when_every_source_stops(spark):
    docs = spark.createDataFrame([(1, "a b c d", "en", "x", 1), (2, "", "en", "y", 1)], DOCS)
    got = {r.source: (r.target, r.taken) for r in mixing.mix_plan(docs).collect()}
    assert got == {"x": (6.0, 6), "y": (0.0, 0)}


ITEMS = [(1, prose(1, 20)), (2, "short item"), (3, "ONE"), (4, None), (5, " , "), (6, prose(9, 13)), (None, prose(3, 15)), (1, prose(1, 20)), (10, prose(1, 20)[:90])]


@pytest.mark.parametrize("block_words", [500_000, 10, 40])
def test_contamination(spark, awkward, clashing, nothing, block_words):
    more = awkward.unionByName(spark.createDataFrame([(20, "x, SHORT--item short Item. " + prose(9, 13).upper(), "en", "a", 1), (21, prose(9, 12), "en", "a", 1)], DOCS))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_contamination(more, items, block_words=block_words)
    got = sorted((r.doc_id, r.match.n_words, r.match.n_hit, len(r.match.item_ids), brute.sha(",".join(r.match.item_ids))) for r in found.collect())
    want = sorted(w[:5] for w in brute.contamination(pairs(more), [("" if i is None else i, t) for i, t in ITEMS]))
    assert got == want
    report = decontaminate.contamination_report(more, items)
    assert rows(report, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(brute.contamination(pairs(more), [("" if i is None else i, t) for i, t in ITEMS]), key=repr)


def test_spans_of_several_blocks_are_united(spark, awkward):
    items = spark.createDataFrame(ITEMS + [(30, prose(1, 40)[30:]), (31, prose(3, 60)[20:])], "item_id long, text string")
    found = [{(r.doc_id, str(r.match)) for r in decontaminate.find_contamination(awkward, items, block_words=n).collect()} for n in (500_000, 15)]
    assert found[0] == found[1] and any("start" in m for _, m in found[0])


def test_decontaminate_edges(spark, clashing, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.decontaminate(clashing, items)
    assert kept.columns == clashing.columns
    assert decontaminate.decontaminate(nothing, items).count() == 0
    assert decontaminate.decontaminate(clashing, items.limit(0)).count() == clashing.count()
    assert decontaminate.text_without("a, b c. d", [(1, 3)]) == "a, . d"
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(clashing, items).collect()}
    assert cut[4] is None and prose(1, 20) not in cut[1] and cut[13] == "one two"


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "WARC/1.1\r\n\r\n\r\n ü"), (6, "u", "z" * 3_000_000), (7, "u", "same"), (None, "u", "none"), (8, "u", "twice"), (8, "u", "twice")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "w")
    warc.write_warc(frame, path, captures_per_file=2)
    captures = warc.resolve_revisits(warc.assemble_captures(warc.read_warc(spark, path)))
    got = captures.selectExpr("regexp_extract(capture_id, 'page:(-?[0-9]*):', 1) as page", "payload_bytes", "payload_digest", "capture.type as type", "regexp_extract(capture.refers_to, 'page:(-?[0-9]*):', 1) as to", "request is not null and metadata is not null as whole", "cast(capture.payload as string) as html").collect()
    want = {str(i): w for i, *w in brute.captures([(i, h) for i, _, h in pages if i is not None])}
    assert len(got) == len(pages) and all(r.whole for r in got)
    for r in got:
        if r.page:
            n, digest, kind, to = want[r.page]
            assert (r.payload_bytes, r.payload_digest, r.type, r.to or None) == (n, digest, kind, None if to is None else str(to))
            assert r.html is None if kind == "revisit" else len(r.html.encode()) == n
    warc.write_warc(frame, path + "2", least_payload=5)
    assert {r.type for r in warc.read_warc(spark, path + "2", payload=False).select("type").distinct().collect()} == {"request", "response", "metadata"}
    warc.write_warc(frame.limit(0), path + "3")
    assert warc.assemble_captures(warc.read_warc(spark, path + "3")).count() == 0


def test_warc_reader_takes_members_and_plain_files():
    import gzip

    one = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for data in (one * 3, gzip.compress(one) * 3, gzip.compress(one * 3)):
        assert [(h["warc-type"], b) for h, b in warc.parse_warc(data)] == [("warcinfo", b"abc")] * 3
    assert list(warc.parse_warc(b"")) == []
    with pytest.raises(ValueError):
        list(warc.parse_warc(one[:-8]))


def test_revisits_of_another_writer(spark, tmp_path):
    import base64
    import hashlib

    digest = base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    block = b"HTTP/1.1 200 OK\r\n\r\nhello"

    def record(kind, name, more, body):
        return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{name}>\r\n{more}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    def revisit(name, to, of):
        return record("revisit", name, f"WARC-Refers-To: <urn:x:{to}>\r\nWARC-Payload-Digest: sha1:{of}\r\n", b"")

    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "one.warc").write_bytes(record("response", "full", "", block) + revisit("good", "full", digest) + revisit("lost", "gone", digest) + revisit("wrong", "full", "A" * 32))
    found = warc.resolve_revisits(warc.assemble_captures(warc.read_warc(spark, str(tmp_path / "w"))))
    assert {r.capture_id[7:-1]: r.payload_bytes for r in found.collect()} == {"full": 5, "good": 5, "lost": None, "wrong": None}


TALK = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "<\\/s> and <\\\\s> [\\INST] <s"), (1, 1, "assistant", "\U0001f600 ß"),
    (2, None, None, None), (2, 0, "odd\nrole\\n", "[/INST"), (None, 3, "assistant", ""), (None, 1, "system", "x\ny"),
    (3, 0, "user", ""), (3, 0, "user", ""), (4, 0, "assistant", "long " * 40_000),
]


def test_chat_round_trip(spark, monkeypatch):
    talk = TALK + [(9, i, ("user", "assistant")[i % 2], f"turn {i} </s>") for i in range(300)]
    frame = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as formatted", "1 as piece")
    for size in (2_000, 7):
        monkeypatch.setattr(chat, "BATCH_TURNS", size)
        formatted = chat.format_chat(frame)
        got = rows(chat.read_back(formatted), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
        assert got == sorted(brute.chats(talk), key=repr)
    assert formatted.where("conv_id = 9").count() > 10
    assert chat.read_back(chat.format_chat(frame.limit(0))).count() == 0


def test_simhash_groups(spark, awkward, nothing):
    groups = simhash.near_duplicate_groups(awkward)
    got = sorted((r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in groups.collect())
    assert got == sorted(brute.groups(pairs(awkward)))
    assert simhash.near_duplicate_groups(nothing).count() == 0 and simhash.deduplicate(nothing).count() == 0


def test_simhash_links_all_pairs_in_reach(spark):
    import random

    draw = random.Random(1)
    centre = [draw.getrandbits(64) for _ in range(30)]
    prints = sorted({c ^ sum(1 << b for b in draw.sample(range(64), k)) for c in centre for k in (0, 1, 2, 3, 4) for _ in range(4)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for segments in (1, 2, 4):
        found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 3 if segments > 1 else 1, segments)
        got = {(r.a, r.b) for r in found.collect()}
        assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= (3 if segments > 1 else 1)}


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200) if i != 120] + [(500, 500)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 if i <= 120 else 121 for i in range(201)}


def test_deduplicate_keeps_one_of_each_group(spark, awkward, clashing):
    want = {}
    for doc_id, _, component in brute.groups(pairs(awkward)):
        want.setdefault(component, doc_id)
    kept = simhash.deduplicate(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_deduplicate_tells_groups_not_ids(spark):
    a, b, c, d = (prose(i, 80) for i in (21, 22, 23, 24))
    table = [
        (None, a, "en", "a", 1), (None, a, "fr", "b", 1), (None, b, "en", "a", 1), (None, None, "en", "a", 1),  # three groups, no id in any
        (1, c, "en", "a", 1), (1, d, "en", "a", 1),  # one id, smallest of two groups
        (0, prose(25, 80), "en", "a", 1), (1, prose(25, 80), "en", "b", 1), (None, prose(25, 80), "en", "c", 1),  # a head's id and null beside a smaller id
        (7, prose(26, 80), "en", "a", 1), (8, prose(26, 80), "en", "a", 1),
    ]
    kept = simhash.deduplicate(spark.createDataFrame(table, DOCS).repartition(3))
    want = [(None, None), (None, a), (None, b), (0, prose(25, 80)), (1, c), (1, d), (7, prose(26, 80))]
    assert rows(kept, "doc_id", "text") == sorted(want, key=repr)


def test_deduplicate_drops_a_copy_that_has_a_heads_id(spark):
    table = [(1, prose(31, 80), "en", "a", 1), (0, prose(32, 80), "en", "a", 1), (1, prose(32, 80), "en", "a", 1)]
    assert rows(simhash.deduplicate(spark.createDataFrame(table, DOCS)), "doc_id", "text") == [(0, prose(32, 80)), (1, prose(31, 80))]


def test_repeats(spark, awkward, nothing):
    got = rows(suffix_dedup.repeat_report(awkward), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.repeats(pairs(awkward)), key=repr)
    assert suffix_dedup.repeat_report(nothing).count() == 0
    kept = {r.doc_id: r.kept for r in suffix_dedup.remove_repeats(awkward).collect()}
    assert kept[13] is None and bytes(kept[1]) == b""


def test_repeats_of_a_wide_bucket_and_small_blocks(spark, awkward, monkeypatch):
    want = sorted(brute.repeats(pairs(awkward)), key=repr)
    monkeypatch.setattr(suffix_dedup, "BUCKET_RUNS", 1)
    assert rows(suffix_dedup.repeat_report(awkward), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    monkeypatch.setattr(suffix_dedup, "BUCKET_RUNS", 4_000)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 300)
    assert rows(suffix_dedup.repeat_report(awkward), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_cover_sort_on_texts_with_few_letters():
    import numpy as np

    from stayflow.llm.cover_sort import repeated

    draw = np.random.default_rng(3)
    for letters, period in ((1, 0), (2, 0), (2, 7), (3, 50)):
        data = draw.integers(97, 97 + letters, 1_500).astype(np.uint8)
        if period:
            data = np.resize(data[:period], 1_500).copy()
            data[::211] = 120
        places = np.arange(0, 1_500 - 64)
        bucket = places % 2
        padded = np.concatenate((data, np.zeros(128, np.uint8)))
        seen = {}
        for p in places:
            seen.setdefault((p % 2, padded[p : p + 64].tobytes()), []).append(p)
        want = np.array([len(seen[p % 2, padded[p : p + 64].tobytes()]) > 1 for p in places])
        assert (repeated(padded, places, bucket, 64) == want).all()


def test_quality(spark, awkward, nothing):
    for limit in (0, 1, 50):
        got = rows(quality_rules.quality_report(awkward, line_limit=limit), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
        assert got == sorted(brute.quality([(r.doc_id, r.text, r.source) for r in awkward.collect()], limit), key=repr)
    assert quality_rules.quality_report(nothing).count() == 0
    left = {r.doc_id: r.text for r in quality_rules.remove_frequent_lines(awkward, line_limit=1).collect()}
    assert left[4] is None and left[13] == "one two" and left[3] == awkward.where("doc_id = 3").first().text


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts(spark, awkward, nothing, name):
    P = pytest.importorskip("public_tokenizers")
    path = P.path(name)
    texts = [" ", "  ", "a  b ", " a", "<s> x </s> <unk>", "▁▁ x ▁", "a\n b\n\n  c", "x" * 5_000, "　 é  ", "<0x0A>"]
    docs = awkward.unionByName(spark.createDataFrame([(100 + i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS))
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    want = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 4096) for i, t in pairs(docs)]
    assert rows(token_counts.token_counts(docs, path), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert token_counts.token_counts(nothing, path).count() == 0


def test_language_edges(spark, awkward, clashing, nothing):
    got = {r.doc_id: r for r in language_id.identify(awkward).collect()}
    assert len(got) == 13 and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (4, 5, 6))
    assert all(r.held_out == brute.held_out(i) for i, r in got.items())
    kept = language_id.keep_identified(clashing)
    assert kept.columns == clashing.columns and not {4, 5, 6} & {r.doc_id for r in kept.collect()}
    assert language_id.identify(nothing).count() == 0
    unlabelled = awkward.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_language_accuracy_on_held_out_documents(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = [r for r in language_id.identify(docs).collect() if r.held_out]
    assert len(found) > 100
    assert sum(truth[r.doc_id] == r.lang_pred for r in found) >= 0.95 * len(found)


def test_network_reads_windows_over_whole_texts():
    raw = [b"a" * 1_000, b"", b"b" * 256, b"c" * 257]
    seen = {i: set() for i in range(4)}
    step = language_id.WINDOW - max(language_id.WIDTHS) + 1
    for windows, owner, sizes in language_id.document_windows(raw):
        for w, o, n in zip(windows, owner, sizes):
            assert bytes(w[:n]) == bytes(w[:1]) * n and not w[n:].any()
            first = len([x for x in seen[o]])
            seen[o].add((first * step, first * step + int(n)))
    for i, text in enumerate(raw):
        assert max(end for _, end in seen[i]) == len(text)


def test_secrets(spark, clashing, nothing):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    import re

    want = {r.doc_id: re.findall(r'(?i)token = "([0-9a-f]{40})"', r.text or "") for r in docs.collect()}
    got = {r.doc_id: r for r in secret_scan.secret_report(docs).collect()}
    true = sum(map(len, want.values()))
    assert true > 5 and len(got) == len(want)
    assert sum(len([s for s in r.secrets if s in want[i]]) for i, r in got.items()) >= 0.95 * true
    assert sum(len([s for s in r.secrets if s not in want[i]]) for i, r in got.items()) <= 0.05 * true
    left = {r.doc_id: r.text for r in secret_scan.redact(docs, path="source").collect()}
    texts = dict(pairs(docs))
    for i, secrets in want.items():
        clean = texts[i]
        for s in got[i].secrets:
            clean = clean.replace(s, secret_scan.REDACTED)
        assert left[i] == clean
    same = secret_scan.redact(clashing, path="source")
    assert same.columns == clashing.columns and rows(same, "doc_id", "text") == rows(clashing, "doc_id", "text")
    assert secret_scan.redact(nothing).count() == 0 and secret_scan.secret_report(nothing).count() == 0


def test_plain_language_counts_all_of_every_text(spark):
    import math
    import re
    from collections import Counter

    texts = ["qzx " * 9_000 + "end" * 6] + [f"plain Words {i}" for i in range(2_500)] + [None, ""]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS).repartition(7)
    words = [w for t in texts for w in re.findall(r"[A-Za-z]{3,15}", t or "")]
    pairs = Counter(w[k : k + 2] for w in words for k in range(len(w) - 1))
    of = Counter()
    for p, n in pairs.items():
        of[p[0]] += n
    triples = Counter(w[k : k + 3].lower() for w in words for k in range(len(w) - 2))
    got = secret_scan.plain_language(docs, groups=6)
    assert got.groups == "|" + "".join(f"{g}|" for g, _ in sorted(triples.items(), key=lambda x: (-x[1], x[0]))[:6])
    index = lambda c: secret_scan.ALPHABET.find(c) + 1
    for p in ("qz", "zx", "en", "dW", "Wo"):
        assert got.transitions[index(p[0]) * 63 + index(p[1])] == pytest.approx(math.log((pairs[p] + 0.1) / (of[p[0]] + 6.3)))


def test_secrets_that_are_rare_among_many_documents(spark):
    import hashlib

    keys = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(3)]
    plain = spark.range(400_000).selectExpr("id as doc_id", "concat('some words and a longwordofplaintext', id % 7, ' with http://host.example/path/', id % 5000, ' end') as text", "'a' as source")
    rare = spark.createDataFrame([(-i - 1, f'here is token = "{k}" end', "a") for i, k in enumerate(keys)], "doc_id long, text string, source string")
    found = secret_scan.secret_report(plain.unionByName(rare)).where("n_secrets > 0").collect()
    assert sorted((r.doc_id, r.secrets) for r in found) == sorted((-i - 1, [k]) for i, k in enumerate(keys))


def test_findings_are_drawn_per_label(spark):
    found = spark.range(3_000).selectExpr("concat('v', id % 2000) as value", "'' as before", "'' as after", "'' as path", "case when id < 3 then 1.0D else 0.0D end as label")
    drawn = secret_scan.drawn_findings(found, 100)
    assert {r.label: r["count"] for r in drawn.groupBy("label").count().collect()} == {0.0: 100, 1.0: 3}
    first = found.where("label = 0").select("value", "before", "after", "path").distinct().selectExpr("*", "xxhash64(value, before, after, path) as draw").orderBy("draw").limit(100)
    assert {r.value for r in drawn.where("label = 0").collect()} == {r.value for r in first.collect()}


def test_secrets_of_other_forms(spark):
    import base64
    import hashlib
    import string

    def drawn(n, letters, seed):
        out = hashlib.sha512(f"{seed}".encode()).digest() + hashlib.sha512(f"{seed}+".encode()).digest()
        return "".join(letters[b % len(letters)] for b in out[:n])

    mixed, upper = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "source")
    planted = {}
    for i in range(12):
        token = f"{drawn(20, mixed, ('j', i))}.eyJ{drawn(30, mixed, ('k', i))}.{drawn(43, mixed, ('l', i))}"
        forms = [
            ("id {}", "AKIA" + drawn(16, upper, ("a", i))), ("clone with {} please", "ghp_" + drawn(36, mixed, ("g", i))),
            ("cookie {}", "eyJ" + token), ("-----BEGIN RSA PRIVATE KEY-----\n{}\n", base64.b64encode(drawn(48, mixed, ("p", i)).encode()).decode()),
            ("password: {}", drawn(20, mixed, ("u", i))), ('api_key = "{}"', drawn(24, mixed, ("q", i))),
            # no rule labels these: bare strings without a known form or a name
            ("see {} there", drawn(40, mixed, ("b", i))), ("see {} there", hashlib.sha256(f"h{i}".encode()).hexdigest()),
        ]
        for k, (around, key) in enumerate(forms):
            planted[-(i * 10 + k + 1)] = (k, around.format(key), key)
    more = spark.createDataFrame([(i, f"Some words before. {text} And after.", "a") for i, (_, text, _) in planted.items()], "doc_id long, text string, source string")
    found = {r.doc_id: r.secrets for r in secret_scan.secret_report(docs.unionByName(more)).collect()}
    hits = [sum(key in found[i] for i, (k, _, key) in planted.items() if k == form) for form in range(8)]
    assert all(h >= 11 for h in hits), hits
    labels = secret_scan.label_by_assignment(secret_scan.findings(more)).where("label = 0")
    assert labels.count() == 0
    plain = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sum(f'token = "{s}"' not in plain[i].lower() for i in plain for s in found[i]) <= 1


def test_candidates_join_to_the_text(spark):
    text = 'k="AAAAAAAAAAAAAAAAAAAAAAAA1" and /very/long/path/to/a/file end'
    frame = spark.createDataFrame([(text,), ("",), (None,)], "text string")
    got = [r.c for r in frame.select(secret_scan.candidates(frame.text).alias("c")).collect()]
    assert [(c.value, c.before[-3:], c.after[:4]) for c in got[0]] == [("AAAAAAAAAAAAAAAAAAAAAAAA1", 'k="', '" an'), ("/very/long/path/to/a/file", "nd ", " end")]
    assert got[1] == [] and got[2] == []


def test_features_equal_plain_ones(spark):
    import math
    import random
    import re

    pick = random.Random(3)
    letters = secret_scan.ALPHABET + "+/_=.~-"
    values = ["".join(pick.choices(letters, k=pick.randint(16, 60))) for _ in range(200)] + ["thequickbrownfox", "AAAAAAAAAAAAAAAA"]
    words = [("key = '", "'"), ("commit ", " x"), ("https://host/", ""), ("", "token"), ("sha256: ", "")]
    cases = [(v, *words[i % 5], "docs" if i % 3 else "src") for i, v in enumerate(values)]
    language = secret_scan.plain_language(spark.createDataFrame([(1, "the quick brown fox and the other words thequick", "en", "a", 1)], DOCS), groups=20)
    frame = spark.createDataFrame(cases, "value string, before string, after string, path string")
    from pyspark.sql import functions as F

    got = frame.select("value", secret_scan.features(F.struct("value", "before", "after"), F.col("path"), language).alias("f")).collect()
    side, index = 63, lambda c: secret_scan.ALPHABET.find(c) + 1
    for (value, before, after, path), r in zip(cases, got):
        n = len(value)
        share = lambda kinds: sum(c in kinds for c in value) / n  # noqa: E731, B023
        lower, upper, digits = secret_scan.LETTERS, secret_scan.LETTERS.upper(), "0123456789"
        want = [
            n, share(lower + upper), share(digits), share(upper), len(set(value)) / n,
            sum(language.transitions[index(a) * side + index(b)] for a, b in zip(value, value[1:])) / (n - 1),
            sum(f"|{value[k : k + 3].lower()}|" in language.groups for k in range(n - 2)) / (n - 2),
            share("+/_=.~-"),
            bool(re.search(secret_scan.KEYWORDS, before)), bool(re.search(secret_scan.KEYWORDS, after)),
            before[-1:] in ("=", ":") or before[-2:] in ("= ", ": ") or before.endswith("= '"), before.endswith("'") and after.startswith("'"),
            bool(re.search(secret_scan.PLACEHOLDERS, value)), "//" in before or "/" in value, path == "docs", before in ("commit ", "sha256: "),
        ]
        assert len(want) == len(secret_scan.FEATURES) == len(r.f)
        assert [float(x) for x in r.f] == [pytest.approx(float(x), abs=1e-12) for x in want], (value, before)
    assert math.isfinite(sum(got[0].f))


def test_trees_as_sql_equal_the_model(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors

    n = len(secret_scan.FEATURES)
    numbers = spark.range(600).selectExpr("id", *[f"(xxhash64(id, {k}) % 1000) / 100.0 as f{k}" for k in range(n)]).selectExpr("id", f"array({', '.join(f'cast(f{k} as double)' for k in range(n))}) as numbers")
    data = numbers.selectExpr("*", "cast(numbers[0] + numbers[3] * numbers[5] > numbers[7] as double) as label").withColumn("features", array_to_vector("numbers"))
    model, forest = secret_scan.fitted(data, trees=7, depth=4, seed=5)
    for r in data.select("numbers", forest.score(data.numbers).alias("score")).collect():
        votes = [t.predict(Vectors.dense(r.numbers)) for t in model.trees]
        assert r.score == pytest.approx(sum(votes) / len(votes))


def test_hashes_are_left_alone_and_secrets_are_not(spark):
    import hashlib

    docs = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "source")
    digest = lambda kind, i: getattr(hashlib, kind)(f"{kind}{i}".encode()).hexdigest()
    hashed = [("commit {}", "sha1"), ("checksum {}", "sha256"), ("sha256: {}", "sha256"), ('etag: "{}"', "md5"), ("integrity={}", "sha512"), ("revision {}", "sha1")]
    planted = [(-(100 * k + i + 1), "It was in " + text.format(digest(kind, i)) + " and no more.", "a") for k, (text, kind) in enumerate(hashed) for i in range(20)]
    secret = [(-(1000 + i), f'Here is token = "{digest("sha1", i + 500)}" and more.', "a") for i in range(40)]
    more = spark.createDataFrame(planted + secret, "doc_id long, text string, source string")
    found = {r.doc_id: r.n_secrets for r in secret_scan.secret_report(docs.unionByName(more)).collect()}
    alone = [sum(found[i] == 0 for i, _, _ in planted[20 * k : 20 * k + 20]) for k in range(len(hashed))]
    print("hashes left alone, of 20:", alone, "secrets found, of 40:", sum(found[i] == 1 for i, _, _ in secret))
    assert min(alone) >= 19 and sum(found[i] == 1 for i, _, _ in secret) >= 38


def test_a_candidate_of_five_megabytes(spark):
    import random
    import time

    pick = random.Random(1)
    letters = secret_scan.ALPHABET + "+/"
    texts = ["".join(pick.choices(letters, k=n)) for n in (500_000, 5_000_000)] + ["a" * 2_000_000, "aB" * 1_000_000, "eyJ" * 300_000, "token" * 200_000]
    language = secret_scan.plain_language(spark.createDataFrame([(1, "some plain words", "en", "a", 1)], DOCS))
    took = []
    for k, text in enumerate(texts):
        frame = spark.createDataFrame([(k, f"x {text} y", "a")], "doc_id long, text string, source string")
        from pyspark.sql import functions as F

        started = time.time()
        found = secret_scan.label_by_assignment(secret_scan.findings(frame)).count()
        judged = secret_scan._marked(frame, language, secret_scan.Forest([(5, -5.0, 1.0, 0.0)]), None, 0.5, "f").select(F.size("f").alias("n"), F.col("f")[0]["score"].alias("score")).first()
        took.append(time.time() - started)
        assert judged.n == 1 and found in (0, 1)
    print([round(t, 1) for t in took])
    # ten times the length in far less than a hundred times the time
    assert took[1] < 30 * max(took[0], 1) and max(took) < 90


def test_no_language_is_lost_to_repeated_rows(spark):
    """Many equal rows of one language, few of another: both are learnt, from different documents."""
    copies = spark.range(50_000).selectExpr("1L as doc_id", "'xx words that are always the same and never change at all' as text", "'xx' as lang")
    others = spark.range(3_000).selectExpr("id as doc_id", "concat('other words number ', id, ' and more of the kind ', id * 7) as text", "'en' as lang")
    drawn = {r.lang: r["count"] for r in language_id.training_windows(copies.unionByName(others)).groupBy("lang").count().collect()}
    assert drawn == {"xx": 1, "en": 400}
    texts = spark.range(900).selectExpr("id as doc_id", "concat('text ', id % 300) as text", "'en' as lang")
    assert language_id.training_windows(texts.unionByName(texts), 2_000).count() == texts.where(~language_id.held_out(texts.doc_id)).count()


def test_network_equals_a_plain_convolution(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    filters = {w: rng.normal(0, 1, (w, 256, language_id.FILTERS)).astype(np.float32) for w in language_id.WIDTHS}
    shift = {w: rng.normal(0, 1, language_id.FILTERS).astype(np.float32) for w in language_id.WIDTHS}
    net = language_id.Network(["a", "b", "c"], filters, shift, rng.normal(0, 1, (language_id.FILTERS * len(filters), 3)).astype(np.float32), rng.normal(0, 1, 3).astype(np.float32))
    windows = rng.integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    got = net.probabilities(windows, net.tables())
    for row, window in zip(got, windows):
        pooled = []
        for w in filters:
            places = range(len(window) - w + 1)
            pooled += [max(sum(float(filters[w][j][window[i + j]][f]) for j in range(w)) for i in places) + float(shift[w][f]) for f in range(language_id.FILTERS)]
        z = np.maximum(pooled, 0) @ net.weights + net.bias
        want = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.allclose(row, want, atol=1e-3)


def test_rows_of_one_page_and_payload_are_all_responses(spark, tmp_path):
    import duckdb

    from stayflow.llm.oracles import ORACLES
    from stayflow.llm.queries import QUERIES

    rows = [(1, "http://a", "same"), (5, "http://b", "same"), (5, "http://c", "same"), (7, "http://d", "x"), (7, "http://d", "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["op3_warc"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    rel = con.sql(ORACLES["op3_warc"])
    assert sorted(map(tuple, got.select(*rel.columns).collect()), key=repr) == sorted(rel.fetchall(), key=repr)


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    pages = spark.range(40).selectExpr("id as page_id", "'u' as url", "concat(id, repeat('ab', 5000)) as html").coalesce(1)
    warc.write_warc(pages, str(tmp_path / "w"), file_bytes=120_000)
    assert len(list((tmp_path / "w").glob("*.gz"))) >= 4
    assert warc.assemble_captures(warc.read_warc(spark, str(tmp_path / "w"))).count() == 40


def test_no_operator_changes_the_session(spark, awkward):
    before = {r.key: r.value for r in spark.sql("set -v").collect()}
    token_counts.token_counts(awkward, tokenizer_path()).count()
    simhash.near_duplicate_groups(awkward, shingle=3, max_bits=3).count()
    warc.write_warc(spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string"), scratch_path(spark, "w"))
    assert {r.key: r.value for r in spark.sql("set -v").collect()} == before


def test_copies_count_as_documents_or_as_texts(spark):
    line = "the very same line of words in every document of this host"
    rows = [(k, f"{line}\n{prose(8, 60)}", "en", "a", 1) for k in range(60)] + [(100 + k, prose(20 + k, 60), "en", "a", 1) for k in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    lines, hosts = quality_rules.document_lines(docs), docs.groupBy("source").count().toDF("host", "documents")
    assert {r.found for r in quality_rules.frequent_lines(lines, hosts, 50).collect()} == {60}
    assert quality_rules.frequent_lines(lines, hosts, 50, of="k1").count() == 0
    assert quality_rules.frequent_lines(lines, hosts, 50, host_share=0.7).count() == 0
