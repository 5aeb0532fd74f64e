"""Token counts at every prefix of a text, by dynamic programming over prefixes.

The vocabulary's merges define one encoding per string. Two neighbouring tokens can stand
next to each other in an encoding exactly if encoding their joined text gives the two back.
So the encoding of a prefix ends in the one token t for which the encoding of what comes
before t ends in a token that can stand before t, and

    count(prefix) = count(prefix without t) + 1.

One pass over a piece's characters fills that table, both for prefixes inside the piece and,
with the vocabulary's word-end mark, for prefixes that end there.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import read, slices

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Distinct words whose counts a task keeps; more start a new table.
KEPT_WORDS = 1_000_000
NEVER, NONE = 1 << 30, (-1,)
#: The vocabulary's own pieces, where a string between white space is ASCII.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


class PrefixCounter:
    """Exact token counts of all prefixes under a vocabulary of merges with a word-end mark."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab, self.mark = model["vocab"], model["end_of_word_suffix"]
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.made = {}
        for i, m in enumerate(self.rank):
            self.made.setdefault("".join(m), (i, *m))
        whole = [t for t in self.vocab if len(self.merged(self.characters(t))) == 1]
        self.inner = frozenset(t for t in whole if not t.endswith(self.mark))
        self.final = frozenset(t.removesuffix(self.mark) for t in whole if t.endswith(self.mark))
        self.longest = max(map(len, self.inner | self.final))
        self.ended: dict[str, int] = {}
        self.library = Tokenizer.from_file(path)
        longest_first = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first)) or r"(?!)")
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.bytes = byte_characters()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Applies the merges, lowest rank first, leftmost first."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.rank.get((symbols[i], symbols[i + 1]), 1 << 30))
            if (symbols[best], symbols[best + 1]) not in self.rank:
                break
            symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]
        return symbols

    def characters(self, token: str) -> list[str]:
        if token.endswith(self.mark) and len(token) > len(self.mark):
            body = token[: -len(self.mark)]
            return [*body[:-1], body[-1] + self.mark]
        return list(token)

    def fits(self, left: str, right: str) -> bool:
        """Whether the two tokens can be neighbours in an encoding.

        Undoes the later of the two tokens' last merges step by step; the pair is impossible
        if at some step a merge across the border would have come before the one undone.
        """
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        a, b, rank, made = left, right, self.rank, self.made
        before, ok = NEVER, True
        while True:
            if rank.get((a, b), NEVER) < before:
                ok = False
                break
            ra, rb = made.get(a, NONE)[0], made.get(b, NONE)[0]
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                before, a = ra, made[a][2]
            else:  # at equal times the left one was merged first, so a merge across of that rank comes before
                before, b = rb + 1, made[b][1]
        self.pairs[left, right] = ok
        return ok

    def prefix_counts(self, piece: str) -> tuple[list[int], list[int]]:
        """For a piece in byte characters: tokens of the encoding of each prefix, as the inside of a longer piece and as a whole piece."""
        n, mark = len(piece), self.mark
        inside, ended, last = [0] * (n + 1), [0] * (n + 1), [""] * (n + 1)
        for end in range(1, n + 1):
            for begin in range(max(0, end - self.longest), end):
                token = piece[begin:end]
                if not last[end] and (begin == 0 or last[begin]) and token in self.inner and (begin == 0 or self.fits(last[begin], token)):
                    last[end], inside[end] = token, inside[begin] + 1
                if not ended[end] and (begin == 0 or last[begin]) and token in self.final and (begin == 0 or self.fits(last[begin], token + mark)):
                    ended[end] = inside[begin] + 1
                if last[end] and ended[end]:
                    break
        return inside, ended

    def ended_count(self, piece: str) -> int:
        """Tokens of a whole piece; as prefix_counts, with the end table filled for the last prefix only."""
        known = self.ended.get(piece)
        if known is not None:
            return known
        n, inner, pairs, fits, longest = len(piece), self.inner, self.pairs, self.fits, self.longest
        count = 0
        if piece in self.final:
            count = 1
        else:
            inside, last = [0] * n, [""] * n
            for end in range(1, n):
                for begin in range(end - longest if end > longest else 0, end):
                    token = piece[begin:end]
                    if token in inner:
                        if not begin:
                            last[end], inside[end] = token, 1
                            break
                        pair = (last[begin], token)
                        if pairs[pair] if pair in pairs else fits(*pair):
                            last[end], inside[end] = token, inside[begin] + 1
                            break
            for begin in range(max(1, n - longest), n):
                if piece[begin:] in self.final and fits(last[begin], piece[begin:] + self.mark):
                    count = inside[begin] + 1
                    break
        if not count:
            raise ValueError(f"no encoding of {piece!r}")
        if len(self.ended) >= KEPT_WORDS:
            self.ended.clear()
        self.ended[piece] = count
        return count

    def pieces(self, word: str) -> list[str]:
        """The pieces of a string without special strings, in byte characters."""
        if word.isascii() and word.isprintable():
            return ASCII_PIECES.findall(word.lower())
        text = self.library.normalizer.normalize_str(word)
        return ["".join(self.bytes[b] for b in p.encode()) for p in self.split.findall(text)]

    def plain_count(self, part: str) -> int:
        """Tokens of a string without special strings."""
        return sum(map(self.ended_count, self.pieces(part)))

    def count(self, word: str) -> int:
        """Tokens of a string between white space."""
        n = self.words.get(word)
        if n is None:
            # special strings are one token each
            n = len(self.special.findall(word)) + sum(map(self.plain_count, self.special.split(word)))
            if len(self.words) >= KEPT_WORDS:
                self.words.clear()
            self.words[word] = n
        return n

    def at_words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ends (code points) of the words of a text, and the exact token count of the prefix up to each."""
        words, count = self.words, self.count
        parts = WORDS_AND_SPACES.split(text)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))[::2]
        counts = [words[w] if w in words else count(w) for w in parts[::2]]
        has = np.array([bool(w) for w in parts[::2]])
        return ends[has], np.cumsum(np.array(counts, np.int64))[has]

    def total(self, text: str) -> int:
        """Tokens of a text: the last entry of the table."""
        words, count = self.words, self.count
        n = 0
        for word in SPACES.split(text):
            if word:
                k = words.get(word)
                n += count(word) if k is None else k
        return n

    def aligned(self, part: str) -> str | None:
        """The normalized string, if its characters are those of the string one by one."""
        if part.isascii() and part.isprintable():
            return part.lower()
        one = self.library.normalizer.normalize_str
        each = [one(c) for c in part]
        return "".join(each) if all(len(c) == 1 for c in each) and one(part) == "".join(each) else None

    def part_counts(self, part: str) -> list[int]:
        """Tokens of each prefix, of one character on, of a string without special strings. Linear in its length, but where characters combine."""
        text = self.aligned(part)
        if text is None:
            return [self.plain_count(part[:k]) for k in range(1, len(part) + 1)]
        out, before = [], 0
        for m in self.split.finditer(text):
            out += [before] * (m.start() - len(out))
            piece = m[0]
            if piece[0] == "'" and piece[1:2].isalpha():  # a short ending, which its prefixes aren't
                each = [self.plain_count(piece[:k]) for k in range(1, len(piece) + 1)]
            else:  # all prefixes are pieces too
                size = np.cumsum([len(c.encode()) for c in piece])
                ended = self.prefix_counts("".join(self.bytes[x] for x in piece.encode()))[1]
                each = [ended[k] for k in size]
            out += [before + n for n in each]
            before = out[-1]
        return out + [before] * (len(text) - len(out))

    def prefix_table(self, text: str) -> np.ndarray:
        """Exact token count of every prefix of the text, by its length in code points from 0 on."""
        out = np.zeros(len(text) + 1, np.int64)
        before, at = 0, 0
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            out[at : m.start() + 1] = before
            at = m.start()
            for special in [*self.special.finditer(text, m.start(), m.end()), None]:
                end = special.start() if special else m.end()
                part = text[at:end]
                out[at + 1 : end + 1] = [before + n for n in self.part_counts(part)]
                if special:  # what begins a special string is text like any other
                    for k in range(1, len(special[0])):
                        out[end + k] = before + self.plain_count(part + special[0][:k])
                    before += self.plain_count(part) + 1
                    at = special.end()
                    out[at] = before
                else:
                    before, at = int(out[end]) if part else before, end
        out[at:] = before
        return out

    def longest_prefix(self, text: str, budget: int) -> int:
        """Code points of the longest prefix of at most that many tokens that ends at a word's end."""
        ends, counts = self.at_words(text)
        k = int(np.searchsorted(counts, budget, "right"))
        return len(text) if k == len(ends) else int(ends[k - 1]) if k else 0


SPACES, WORDS_AND_SPACES = re.compile(r"[\x20\x09-\x0D]+"), re.compile(r"([\x20\x09-\x0D]+)")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, prefixes: bool = False) -> DataFrame:
    """Exact token counts of every text.

    Returns per row: doc_id, n_bytes, n_tokens, over_limit, fit_chars (code points of the
    longest prefix within the limit that ends with a word; the whole text if it is within it)
    and, where prefixes is true, the table itself: word_ends and word_counts, from which
    truncation to any budget follows without encoding again (within). Special strings inside
    texts are one token each, as the library has it. Null text counts as empty (0
    tokens); a null doc_id stays null; repeated rows stay; texts of any length are counted
    whole.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        table = counter(path)
        for batch in slices(batches):
            total, fit, ends, counts = [], [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                if prefixes:
                    e, c = table.at_words(text)
                    n = int(c[-1]) if len(c) else 0
                    ends.append(e)
                    counts.append(c)
                elif (n := table.total(text)) > limit:
                    e, c = table.at_words(text)
                k = int(np.searchsorted(c, limit, "right")) if n > limit else 0
                total.append(n)
                fit.append(len(text) if n <= limit else int(e[k - 1]) if k else 0)
            columns = {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": pa.array(total, pa.int64()), "fit_chars": pa.array(fit, pa.int64())}
            if prefixes:
                at = pa.array(np.concatenate(([0], np.cumsum([len(c) for c in counts]))), pa.int32())
                columns |= {name: pa.ListArray.from_arrays(at, pa.array(np.concatenate(x), pa.int32())) for name, x in (("word_ends", ends), ("word_counts", counts))}
            yield pa.RecordBatch.from_pydict(columns)

    frame = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = frame.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, fit_chars long" + ", word_ends array<int>, word_counts array<int>" * prefixes)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def truncated(docs: DataFrame, budget: int, path: str | None = None) -> DataFrame:
    """The longest word-ended prefix of each text within the budget: doc_id, n_chars, n_tokens."""
    return within(token_counts(docs, path, prefixes=True), budget)


def within(table: DataFrame, budget: int) -> DataFrame:
    """doc_id, n_chars and n_tokens of each text's longest word-ended prefix within the budget, from a stored table of token_counts with prefixes alone."""
    fit = F.expr(f"size(filter(word_counts, c -> c <= {int(budget)}))")
    end = F.when(fit == 0, 0).otherwise(F.element_at("word_ends", F.greatest(fit, F.lit(1))))
    return table.select("doc_id", end.cast("long").alias("n_chars"), F.when(fit == 0, F.lit(0)).otherwise(F.element_at("word_counts", F.greatest(fit, F.lit(1)))).cast("long").alias("n_tokens"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the table of every text: where each word ends, and the tokens up to there."""
    return token_counts(read(spark, sf_dir, "documents"), prefixes=True)
