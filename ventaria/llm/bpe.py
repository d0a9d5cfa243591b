"""BPE encoding by backtracking, and decoding with an offset table.

A word's exact merge result is found without merging: an Aho-Corasick automaton
over reversed tokens names the longest token that starts at each place of the
word; tokens are laid down greedily, a pair of neighbours must be compatible
(merging the two tokens' own symbols gives back just these two), and on a
conflict the last token gives way to its next shorter prefix. Places from which
no rest fits are remembered, so each place is left once: linear time. Pair
verdicts live in a table filled as pairs occur. Decoding copies byte ranges of
one token buffer named by an offset table.

The vocabulary file is a parameter; the driver reads it and sends its text (one
fixed vocabulary, 1.7 MB) to the tasks. Encoding is one scan, no shuffle.

Defined results: null or empty text has no ids and decodes to the empty text;
repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from ventaria.llm import text as T

END = "\ue000"  # stands for the word-end mark; no byte symbol uses it
CACHE_WORDS = 300_000


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = dict(zip(shown, shown)) | {b: 256 + k for k, b in enumerate(hidden)}
    return [chr(names[b]) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file (word-end BPE over byte symbols)."""

    def __init__(self, definition: str, young: str = "", small: tuple[tuple[int, str], ...] = ()):
        spec = json.loads(definition)
        mark, vocab = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
        self.symbols = str.maketrans(dict(enumerate(byte_symbols())))
        inner = lambda t: t[:-len(mark)] + END if t.endswith(mark) and len(t) > len(mark) else t
        self.ids = {inner(t): k for t, k in vocab.items()}
        self.tokens = {k: t for t, k in self.ids.items()}
        self.ranks = {(inner(a), inner(b)): r for r, (a, b) in enumerate(spec["model"]["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern, regex.V0)
        self.small = dict(small)
        self.first_young = min([*young, *map(chr, self.small)], default=chr(0x10FFFF))
        for kind in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(kind, f"[{kind}--[{young}]]") if young else pattern
        self.wide_pattern = regex.compile(pattern, regex.V1)
        self.automaton = ahocorasick.Automaton()
        for token in self.ids:
            self.automaton.add_word(token[::-1], len(token))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        strings = {k: t for t, k in vocab.items()} | {k: t for t, k in self.special.items()}
        texts = [strings.get(k, "").encode() + b" " for k in range(max(strings) + 1)]
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.buffer = np.frombuffer(b"".join(texts), np.uint8)

    def symbols_of(self, token: str) -> list[str]:
        """Base symbols; the word-end mark belongs to the last one."""
        return [*token[:-2], token[-2:]] if token.endswith(END) else [*token]

    def merged(self, parts: list[str]) -> list[str]:
        """Plain merging of a few symbols; only used to fill the pair table."""
        while len(parts) > 1:
            rank, k = min((self.ranks.get((parts[k], parts[k + 1]), len(self.ranks)), k) for k in range(len(parts) - 1))
            if rank == len(self.ranks):
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the symbols of both gives just these two; with no ``left``, of a token alone."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > CACHE_WORDS:
                self.pairs.clear()
            parts = (self.symbols_of(left) if left else []) + self.symbols_of(right)
            known = self.pairs[left, right] = self.merged(parts) == ([left, right] if left else [right])
        return known

    def tokens_of(self, word: str) -> list[str]:
        """Tokens of a word in byte symbols that ends with the word-end mark."""
        n = len(word)
        longest = [0] * n  # of the token that starts here
        for end, size in self.automaton.iter(word[::-1]):
            longest[n - 1 - end] = max(longest[n - 1 - end], size)
        dead, out, at = bytearray(n + 1), [], 0
        dead[n - 1] = 1  # the mark never stands alone
        size = longest[0]
        while at < n:
            while size:
                token = word[at:at + size]
                if not dead[at + size] and token in self.ids and self.compatible(out[-1] if out else "", token):
                    break
                size -= 1
            if size:
                out.append(token)
                at += size
                size = longest[at] if at < n else 0
            else:
                if not out:
                    raise ValueError("a byte symbol is missing in the vocabulary")
                dead[at] = 1
                size = len(out.pop())
                at -= size
                size -= 1
        return out

    def word_ids(self, word: str) -> bytes:
        made = self.words.get(word)
        if made is None:
            if len(self.words) > CACHE_WORDS:
                self.words.clear()
            symbols = word.encode().decode("latin-1").translate(self.symbols) + END
            made = self.words[word] = np.array([self.ids[t] for t in self.tokens_of(symbols)], "<u4").tobytes()
        return made

    def plain(self, text: str) -> bytes:
        pattern = self.pattern
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # each character is lowered by itself
            if max(text) >= self.first_young:
                pattern, text = self.wide_pattern, text.translate(self.small)
        return b"".join(map(self.word_ids, pattern.findall(text.lower())))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if self.split_special is None or "<" not in text:
            return self.plain(text)
        return b"".join(self.special[part].to_bytes(4, "little") if part in self.special else self.plain(part)
                        for part in self.split_special.split(text) if part)

    def decode(self, ids: bytes) -> bytes:
        """Tokens joined by one blank, as UTF-8."""
        ids = np.frombuffer(ids, "<u4")
        if not len(ids):
            return b""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        return self.buffer[np.arange(ends[-1]) + np.repeat(self.offsets[ids] - (ends - size), size)][:-1].tobytes()


@lru_cache(2)
def codec_of(definition: str, young: tuple[str, tuple[tuple[int, str], ...]] = ("", ())) -> Codec:
    return Codec(definition, *young)


def young_letters() -> tuple[str, tuple[tuple[int, str], ...]]:
    """Where character tables of different age disagree with the tokenizers library's own.

    Letters and digits of this regex module that the library does not know yet,
    and small letters that it knows and this Python does not.
    """
    from tokenizers import Regex
    from tokenizers.normalizers import Lowercase
    from tokenizers.pre_tokenizers import Split

    every = "".join(map(chr, (*range(128, 0xD800), *range(0xE000, 0x110000))))
    doubtful = "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")
    known = Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True).pre_tokenize_str(doubtful)
    known = {c for c, _ in known}
    small = ((c, Lowercase().normalize_str(c)) for c in sorted(doubtful))
    return "".join(sorted(set(doubtful) - known)), tuple((ord(c), x) for c, x in small if x != c)


def tokenizer_text(path: str | None = None) -> str:
    """The vocabulary file, read by the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int), decoded text."""
    parts = docs.sparkSession.sparkContext.broadcast((tokenizer_text(path), young_letters()))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = codec_of(*parts.value)
        ids = [codec.encode(t) for t in T.texts_of(batch)]
        cuts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
        flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
        return T.named_batch(doc_id=batch.column("doc_id"), ids=pa.ListArray.from_arrays(pa.array(cuts), flat),
                             decoded=pa.array([codec.decode(x).decode() for x in ids], pa.string()))

    return T.scan(T.id_and_text(docs), step, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the same codec, digests taken where the ids are."""
    parts = docs.sparkSession.sparkContext.broadcast((tokenizer_text(path), young_letters()))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = codec_of(*parts.value)
        ids = [codec.encode(t) for t in T.texts_of(batch)]
        return T.named_batch(doc_id=batch.column("doc_id"), n_tokens=np.array([len(x) // 4 for x in ids], np.int64),
                             ids_sha256=pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                             decoded_sha256=pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in ids]))

    return T.scan(T.id_and_text(docs), step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(T.documents(spark, sf_dir))
