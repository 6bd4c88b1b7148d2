"""Secrets, token counts, encoding, quality statistics and licenses against plain versions."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest

from stallmetrics.llm import bpe, licenses, quality, secrets, token_counts
from tests.llm.conftest import LONG, ODD

KEY = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(rf"(?:{KEY}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def plain_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(found)


def noise(pieces, n, size, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(size))) for _ in range(n)]


SECRET_PIECES = ["token", "=", " ", ":", '"', "'", "secret", "PassWord", "passwd", "api_key", "apikey", "abc", "AKIA", "é", "ſ", "K",
                 "0123456789abcdef", "ABCDEFGH12", "x", "\n", "=abcdef", "token=token: abcdef", "deadbeef" * 3]


def test_secret_spans_equal_regular_expressions():
    given = noise(SECRET_PIECES, 1500, 60, 1) + [t or "" for t in ODD] + ["f" * 9000 + " " + "e" * 23]
    for text, spans in zip(given, secrets.scanner().scan(given), strict=True):
        assert [s for s in spans if s[1] < 3] == plain_secrets(text)


def test_more_kinds_and_redaction(make):
    text = "ü key ghp_" + "a1" * 18 + " and -----BEGIN RSA PRIVATE KEY----- and xoxb-1234567890-ab, token = abcdefgh!"
    got = {s[1] for s in secrets.scanner().scan([text])[0]}
    assert {secrets.RULES[k].kind for k in got} == {"assign", "hex", "forge_token", "private_key", "chat_token"}
    rows = secrets.redact_secrets(make([text, "clean", None])).orderBy("doc_id").collect()
    assert rows[0]["text"] == "ü key [secret] and [secret] and [secret], [secret]!"
    assert rows[0]["n_chars"] == len(rows[0]["text"])
    assert [r["text"] for r in rows[1:]] == ["clean", None] and rows[1]["spans"] == "x"


def test_secret_query_rows(make):
    rows = secrets.secret_digests(make(["password: hunter22", None, "password: hunter22"], [5, 6, 5])).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == [5, 5, 6]
    assert rows[0]["n_assign"] == 1 and rows[0]["spans"] == "assign:0:18"
    assert rows[0]["base_sha256"] == hashlib.sha256(b"assign:0:18").hexdigest()
    assert rows[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secrets.scan_secrets(make(["password: hunter22"])).first()["spans"][0]["end"] == 18


def test_minimal_automaton_is_smaller_and_total():
    auto = secrets.scanner().starts
    assert len(auto.step) == len(auto.accepts) * auto.n_classes and auto.step.max() < len(auto.accepts)
    with pytest.raises(ValueError):
        secrets.compile_rules([rb"[^a]"])


TEXT_PIECES = ["a", "e", "th", "ing", " ", "  ", "\n", "\t", "'s", "'LL", "É", "é", "e\u0301", "ß", "Σ", "日本", "\u00a0", "\x1c", "\x00", "1",
               "½", "!", "...", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "😀", "İ", "ſ", "Aaaa", "aaaaaaa", "_", "▁", " ▁"]


def test_token_counts_equal_the_library(make):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    given = noise(TEXT_PIECES, 300, 80, 2) + ODD
    got = token_counts.count_tokens(make(given), path).orderBy("doc_id").collect()
    want = [len(model.encode(t or "")) for t in given]
    assert [r["n_tokens"] for r in got] == want
    assert [r["n_bytes"] for r in got] == [len((t or "").encode()) for t in given]
    assert [r["over_limit"] for r in got] == [n > 4096 for n in want]


def test_parts_join_to_the_text():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for text in noise(TEXT_PIECES, 200, 200, 3):
        parts = token_counts.safe_parts(text, 15)
        assert " ".join(parts) == text
        assert sum(len(model.encode(p)) for p in parts) == len(model.encode(text))


def test_encoding_equals_the_library(make):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    given = noise(TEXT_PIECES, 500, 40, 4) + ODD
    got = bpe.round_trip(make(given), path).orderBy("doc_id").collect()
    encoded = bpe.encode_texts(make(given), path)
    assert "text" not in encoded.columns
    decoded = {r["doc_id"]: r["text"] for r in bpe.decode_ids(encoded, path).collect()}
    for k, (text, row) in enumerate(zip(given, got, strict=True)):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids), text
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest() and decoded[k] == back


def test_trie_equals_merging_by_rank():
    encoder = bpe.codec(public_tokenizers.path("word_bpe_49k.json")).encoder
    words = list({w for w in noise(list("abcdeinorst") + ["th", "ing", "tion"], 1500, 14, 5) if w})
    got = encoder.encode_words(words)
    assert all(got[w] == encoder.merge([*w[:-1], w[-1] + "</w>"]) for w in words)


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else None
    covered = {i + k for i, w in enumerate(windows) if twice and w in twice for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_statistics_equal_plain_ones():
    pieces = ["a ", "b ", "c ", "\n", "x\r\n", "é#", "*", " \x0b", "\u00a0", "a b c ", "\x1f"]
    for text in noise(pieces, 600, 50, 6) + ["", "a", "a a a a"]:
        assert quality.text_counts(text)[:5] == plain_counts(text)


def test_learned_list_separates_what_thresholds_separate(make, spark):
    rng = random.Random(7)
    good = [" ".join(f"w{rng.randrange(4000)}" for _ in range(80)) for _ in range(150)]
    bad = [" ".join(f"w{rng.randrange(4000)}***" for _ in range(80)) for _ in range(60)]
    docs = make(good + bad + ODD)
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(210)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rules = quality.fit_rules(docs, labels)
    assert rules
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, rules).collect()}
    assert all(kept[i] == (i < 150) for i in range(210)) and not kept[210] and not kept[211]
    stays = quality.keep_good(docs, rules)
    assert stays.columns == docs.columns
    assert {r["doc_id"] for r in stays.collect()} == {i for i, k in kept.items() if k}
    assert quality.fit_rules(docs, labels.limit(0)) == []


def plain_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    found = []
    for phrase, label in licenses.PHRASES.items():
        w = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(w)] == w]
    return len(words), sorted(found)


def test_license_places_equal_a_plain_search(make):
    pieces = ["cc ", "by ", "General ", "public-", "license, ", "all ", "RIGHTS ", "reserved ", "é ", "x", "K", "\x00", "9 "]
    given = noise(pieces, 150, 60, 8) + ODD
    got = licenses.scan_licenses(make(given)).orderBy("doc_id").collect()
    assert len(got) == len(given)
    for text, row in zip(given, got, strict=True):
        n, places = plain_places(text or "")
        assert row["n_words"] == n and row["n_base"] == len(places)
        assert (row["first_word"], row["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert row["base_labels"] == ",".join(sorted({p[1] for p in places}))
        assert 0 <= row["score"] <= 1


def test_notices_with_words_put_in_and_left_out(make):
    words = licenses.NOTICES["mit"].split()
    changed = words[:9] + ["really"] + words[9:16] + words[17:]
    rows = licenses.scan_licenses(make([" ".join(changed), " ".join(words[:8]), "Copyright " + " ".join(words).upper(), " ".join(changed)],
                                       [0, 1, 2, 0])).orderBy("doc_id").collect()
    assert [r["labels"] for r in rows] == ["mit", "mit", "", "mit"]
    assert rows[3]["score"] == 1.0 and 0.6 <= rows[0]["score"] < 1


def test_notices_with_long_insertions(make):
    """Stretches of foreign words, left-out words, another order, a notice that is there twice, and too long a span."""
    words = licenses.NOTICES["zlib-text"].split()
    n = len(words)
    foreign = [f"x{k}" for k in range(30)]
    half = words[n // 2:] + words[:n // 2]
    given = [words, words[:40] + foreign + words[40:], words[:30] + foreign[:5] + words[30:60] + foreign[5:9] + words[60:80] + words[84:],
             words[:n // 3] + foreign * 9 + words[n // 3:2 * n // 3] + foreign * 9 + words[2 * n // 3:], half,
             ["of", "the", "software"] * 3000 + words, words[:20] + foreign + words, sorted(words)]
    rows = licenses.scan_licenses(make([" ".join(g) for g in given])).orderBy("doc_id").collect()
    assert ["zlib-text" in r["labels"].split(",") for r in rows] == [True, True, True, False, False, True, True, False]
    assert [r["score"] for r in rows if r["doc_id"] in (0, 5, 6)] == [1.0, 1.0, 1.0]
    assert rows[1]["score"] == (n - 2 - 2) / (n - 2)


def plain_share(text, template):
    """The largest share of a template's word triples that some chain of votes covers, votes one by one."""
    k = licenses.NOTICE_WORDS
    at = {}
    for j in range(len(template) - k + 1):
        at.setdefault(tuple(template[j:j + k]), []).append(j)
    votes = [(i, j) for i in range(len(text) - k + 1) for j in at.get(tuple(text[i:i + k]), [])]
    runs = {}
    for i, j in votes:
        runs.setdefault(i - j, []).append(i)
    pieces = []
    for d, places in runs.items():
        for i in sorted(places):
            if pieces and pieces[-1][0] == d and pieces[-1][2] == i - 1:
                pieces[-1][2] = i
            else:
                pieces.append([d, i, i])
    pieces.sort(key=lambda x: (x[1], x[2]))
    n = len(template)
    best = 0
    for d, low, high in pieces:
        chains = [(high, high - d, high - low + 1)]
        for e, a, b in pieces:
            if a >= low and b - low + k <= licenses.STRETCH * n and abs(e - d) <= (licenses.STRETCH - 1) * n + k:
                before = [c[2] for c in chains if c[0] < a and c[1] < a - e]
                if before:
                    chains.append((b, b - e, max(before) + b - a + 1))
        best = max(best, *(c[2] for c in chains))
    return best / (n - k + 1)


def test_notice_scores_equal_plain_chains(make, spark):
    rng = random.Random(3)
    letters = "abcdefg"
    notices = [(f"n{k}", " ".join(rng.choice(letters) for _ in range(rng.randrange(4, 25)))) for k in range(6)]
    given = []
    for _ in range(60):
        text = []
        for _ in range(rng.randrange(4)):
            part = rng.choice(notices)[1].split()
            cut = rng.randrange(len(part))
            text += part[:cut] + rng.choices(letters + "xyz", k=rng.randrange(7)) + part[cut + rng.randrange(3):]
            text += rng.choices("xyz", k=rng.randrange(9))
        given.append(text)
    table = spark.createDataFrame([*notices, notices[0], (None, "a b c d"), ("empty", None), ("short", "a b")], "label string, text string")
    got = licenses.scan_licenses(make([" ".join(g) for g in given]), notices=table).orderBy("doc_id").collect()
    hits = 0
    for text, row in zip(given, got, strict=True):
        shares = {label: plain_share(text, t.split()) for label, t in notices}
        found = {label: x for label, x in shares.items() if x >= licenses.SHARE}
        assert row["labels"] == ",".join(sorted(found))
        assert abs(row["score"] - max(found.values(), default=0)) < 1e-12
        hits += len(found)
    assert hits > 40


def test_templates_beyond_the_broadcast(make, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_GRAMS", 0)
    spark = make([]).sparkSession
    table = licenses.as_table(spark, list(licenses.NOTICES.items()))
    given = make([licenses.NOTICES["isc-text"], "cc by", *ODD])
    assert sorted(map(tuple, licenses.scan_licenses(given, notices=table).collect()), key=str) == sorted(
        map(tuple, licenses.scan_licenses(given).collect()), key=str)


def test_empty_tables(make, spark):
    none = make([])
    path = public_tokenizers.path("word_bpe_49k.json")
    for df in (secrets.secret_digests(none), secrets.redact_secrets(none), quality.judge(none, []), quality.keep_good(none, []),
               licenses.scan_licenses(none), bpe.round_trip(none, path), bpe.encode_texts(none, path),
               token_counts.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model"))):
        assert df.count() == 0
    assert len(LONG) > 1 << 18 and np.array(quality.text_counts(LONG)).min() >= 0
