"""Byte-pair encoding and decoding over a trie of words.

The encoding of a text's prefix is the encoding of a shorter prefix plus one last token,
and a sequence of tokens is an encoding exactly if each two neighbours are the encoding of
their own join. The distinct new words of a batch go into a trie; a depth-first walk finds
each node's last token from the states above it, so a shared prefix is encoded once. A word's tokens are read back along the last tokens of its path.

Texts are cut at ASCII white space, which no token crosses. Plain printable ASCII is split
into words here; all else is normalised and split by the tokenizer file's own components.
Special strings inside a text become their special token, as the library does.

Null or empty text: no tokens, the digests are those of the empty string. Repeated rows
are encoded one by one; the cache of chunks is bounded.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from stallmetrics.llm.common import sized, texts

#: Chunks and pairs of tokens that a worker remembers.
CACHE_CHUNKS = 700_000
CACHE_PAIRS = 1_000_000
_END = "</w>"
#: Printable ASCII and the composed Latin letters up to U+017F but for the dotted capital I: composed, and lower-cased
#: one to one, so their words can be found here.
_LATIN = re.compile(r"[!-~À-ÖØ-öø-įı-ſ]+")
_LATIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")


class TrieEncoder:
    """Encoder of words (strings of the model's byte symbols, ended by its word-end mark)."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        self.rank = {tuple(pair): k for k, pair in enumerate(merges)}
        self.longest = max(len(t.removesuffix(_END)) for t in vocab)
        self.pairs: dict[tuple[str, str], bool] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """The definition: join the best-ranked pair, leftmost first, until none is left."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best = min((self.rank.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if best[0] == 1 << 30:
                break
            symbols[best[1]:best[1] + 2] = [symbols[best[1]] + symbols[best[1] + 1]]
        return symbols

    @staticmethod
    def symbols(token: str) -> list[str]:
        if token.endswith(_END) and len(token) > len(_END):
            body = token[:-len(_END)]
            return [*body[:-1], body[-1] + _END]
        return list(token)

    def fits(self, left: str, token: str) -> bool:
        """Is ``left`` then ``token`` the encoding of their join? ``left`` is empty at a word's start."""
        key = (left, token)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            symbols = self.symbols(left) if left else []
            known = self.merge(symbols + self.symbols(token)) == ([left] if left else []) + [token]
            self.pairs[key] = known
        return known

    def encode_words(self, words: list[str]) -> dict[str, list[str]]:
        """The tokens of each distinct word.

        The trie is held as the sorted words: a node is a prefix that neighbours share, and
        going through them in order is its depth-first walk. ``last`` has the last token of
        each prefix of the present path; a word keeps the states of the prefix it shares.
        """
        out: dict[str, list[str]] = {}
        vocab, pairs, fits, most = self.vocab, self.pairs, self.fits, self.longest
        before, last = "", [""]
        for word in sorted(words):
            size = len(word)
            shared, top = 0, min(size, len(before)) - 1
            while shared < top and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:]
            before = word
            for depth in range(shared + 1, size + 1):
                text = word[:depth] if depth < size else word + _END
                for start in range(depth - most if depth > most else 0, depth):
                    token = text[start:]
                    if token in vocab:
                        fit = pairs.get((last[start], token))
                        if fit or fit is None and fits(last[start], token):
                            last.append(token)
                            break
                else:
                    raise ValueError(f"no encoding for {word!r}: the vocabulary lacks a symbol of it")
            tokens, at = [token], start
            while at:
                token = last[at]
                tokens.append(token)
                at -= len(token)
            out[word] = tokens[::-1]
            del last[size:]  # the state of the ended word is no prefix of another
        return out


class Codec:
    """Chunk-wise encoding with the tokenizer file at ``path``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        model = given["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != _END or given["decoder"] is not None:
            raise ValueError("a BPE tokenizer with word ends and without a decoder is asked for")
        self.vocab = dict(model["vocab"])
        self.encoder = TrieEncoder(self.vocab, [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.token_of = {i: t for t, i in {**self.vocab, **self.special}.items()}
        parts = Tokenizer.from_file(path)
        self.normalizer, self.splitter = parts.normalizer, parts.pre_tokenizer
        self.symbol_of = {c.encode()[0]: self.splitter.pre_tokenize_str(c)[0][0][0] for c in "ÀĀŀ"}
        self.symbol_of |= {b: self.splitter.pre_tokenize_str(chr(b + 64))[0][0][1] for b in range(0x80, 0xC0)}
        self.text_of = {t: str(i) for t, i in self.vocab.items()}
        self.known: dict[bytes, tuple[str, str]] = {}

    def _words(self, chunk: str) -> list[str]:
        """The chunk's words in the model's byte symbols."""
        if not _LATIN.fullmatch(chunk):
            return [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))]
        chunk = chunk.lower()
        words = [chunk] if chunk.isalpha() else _LATIN_WORDS.findall(chunk)
        if chunk.isascii():
            return words
        return [w if w.isascii() else w.encode().decode("latin-1").translate(self.symbol_of) for w in words]

    def _learn(self, chunks: set[bytes]) -> None:
        """Adds new chunks: their words into one trie, then the chunks from their words.

        A word of plain lower-case letters is a chunk too, so a known one is taken as it is.
        """
        known, special = self.known, self.special
        found: dict[str, tuple[str, str]] = {}
        split: list[tuple[bytes, list[str]]] = []
        fresh: list[str] = []
        for raw in chunks:
            chunk = raw.decode()
            if self.cut and "<|" in chunk:
                parts = [w for p in self.cut.split(chunk) if p for w in ([p] if p in special else self._words(p))]
            else:
                parts = self._words(chunk)
            split.append((raw, parts))
            for word in parts:
                if word not in found:
                    same = known.get(word.encode()) if word.isalpha() and word.isascii() else None
                    if same is None:
                        if word in special:
                            same = (str(special[word]), word)
                        else:
                            fresh.append(word)
                    found[word] = same
        text_of = self.text_of
        for word, tokens in self.encoder.encode_words(fresh).items():
            found[word] = (" ".join([text_of[t] for t in tokens]), " ".join(tokens))
        for raw, parts in split:
            if len(parts) == 1:
                known[raw] = found[parts[0]]
            else:
                pairs = [found[w] for w in parts]
                known[raw] = (" ".join([p[0] for p in pairs]), " ".join([p[1] for p in pairs]))

    def chunks(self, given: list[str]) -> list[list[tuple[str, str]]]:
        """Of each text, per chunk that has tokens: the ids as text, and the decoded text.

        Beyond the bound of the cache only the chunks of these texts stay in it.
        """
        cut = [t.encode().split() for t in given]
        seen = set().union(*cut)
        known = self.known
        missing = seen - known.keys()
        if len(known) + len(missing) > CACHE_CHUNKS:
            self.known = {c: known[c] for c in seen if c in known}
        if missing:
            collecting = gc.isenabled()
            gc.disable()  # many small tuples, no cycles
            try:
                self._learn(missing)
            finally:
                if collecting:
                    gc.enable()
        known = self.known
        found = [[known[c] for c in words] for words in cut]
        return [[k for k in f if k[0]] for f in found] if any(not known[c][0] for c in seen) else found

    def encode(self, given: list[str]) -> list[list[int]]:
        return [[int(i) for ids, _ in found for i in ids.split(" ")] for found in self.chunks(given)]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.token_of[i] for i in ids)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """Loaded once per worker process."""
    return Codec(path)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """The given columns without ``text``, and the ids of its tokens. Given columns that are named
    ``ids`` or ``n_tokens``, in letters of any case, are replaced; others may have any names."""
    names = [c for c in docs.columns if c != "text" and c.lower() not in ("ids", "n_tokens")]
    plain = docs.toDF(*["text" if c == "text" else f"extra_{k}" for k, c in enumerate(docs.columns)])
    keep = [f"extra_{k}" for k, c in enumerate(docs.columns) if c in names]

    def encode(batches):
        for batch in sized(batches, "text"):
            ids = codec(path).encode(texts(batch))
            yield pa.RecordBatch.from_arrays(
                [*(batch[k] for k in keep), pa.array([len(i) for i in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                names=[*keep, "n_tokens", "ids"])

    given = plain.select(*keep, "text")
    schema = StructType([*(f for f in given.schema if f.name != "text"), StructField("n_tokens", LongType()),
                         StructField("ids", ArrayType(IntegerType()))])
    return given.mapInArrow(encode, schema).toDF(*names, "n_tokens", "ids")


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of ``ids``; null ids give an empty text."""

    def decode(batches):
        for batch in batches:
            found = [codec(path).decode(i or []) for i in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them."""

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches):
        for batch in sized(batches, "text"):
            n, ids, decoded = [], [], []
            for found in codec(path).chunks(texts(batch)):
                joined = " ".join([k[0] for k in found])
                n.append(joined.count(" ") + 1 if joined else 0)
                ids.append(digest(joined))
                decoded.append(digest(" ".join([k[1] for k in found])))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
