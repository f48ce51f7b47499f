"""Byte-pair encoding by speculation and verification, and decoding.

A word's tokens are proposed by greedy longest match over a trie of the vocabulary, for all
different words of a slice at once. A row of tokens is what merging gives if, and only if, every adjacent
pair of it is *compatible*: encoding the two tokens' symbols together gives the two tokens. That is decided in numpy
by going back in time along the right edge of the left token and the left edge of the right one:
a pair is incompatible where some merge over the border comes before the merges that hide its two sides
(of equal ranks the left one goes first). Only words with an incompatible pair are merged exactly, by rank.

The tokenizer file is checked (``Rules``): a BPE model without dropout, subword prefix, unknown or byte fallback,
each token made by one merge of earlier ones, over byte-level pieces. Any other file is encoded and decoded by the
library, whole text by whole text. Texts of ASCII and Latin-1 letters are cut into words in
numpy where the file has the usual rule; all other texts are normalised and cut by the library itself.

Defined cases: a null text is an empty one and has no ids; null ids decode to an empty text; ids without a
token are left out, as the library does; words and texts of any length are whole (a cell holds up to 2 GB); repeated
rows stay; an empty table gives an empty one; columns beside the text are not read, but those named in ``keep`` are carried.
"""

from __future__ import annotations

import heapq
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm import wordhash as W
from lodestrata.llm.memory import lean

SLICE_BYTES = 1 << 22
LONG_WORD = 256
"""Words of more symbols are matched one by one; below, all words of a slice together."""
NEVER = np.int64(1) << 40

# The usual normalizer and pre-tokenizer, whose words numpy can find in plain texts.
USUAL_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
USUAL_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}

LETTER, DIGIT, OTHER, WHITE = 0, 1, 2, 3
_CLASS = np.full(256, OTHER, dtype=np.uint8)
_CLASS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), 0xC3]] = LETTER
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[[0x20, *range(0x09, 0x0E)]] = WHITE
_STRANGE = np.zeros(256, dtype=bool)
_STRANGE[[*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F, 0xC0, 0xC1, 0xC2, *range(0xC4, 0x100)]] = True
"""Bytes of texts that the library cuts: controls, and all beyond ASCII but the letters U+00C0 to U+00FF."""


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the letters from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class Lookup:
    """A map of non-negative integers to integers, asked for whole arrays: open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(10, int(4 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        keys, values = np.asarray(keys, np.int64), np.asarray(values, np.int64)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]] = keys[free]  # of several for one place, one wins
            won = free[self.keys[at[free]] == keys[free]]
            self.values[at[won]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


class Rules:
    """Vocabulary and merges of a tokenizer file. ``fits`` tells whether speculation is right for it."""

    def __init__(self, said: dict):
        model, cut = said["model"], said.get("pre_tokenizer") or {}
        steps = cut.get("pretokenizers", [cut])
        plain = said.get("truncation") is None and said.get("padding") is None and said.get("post_processor") is None
        self.fits = bool(
            plain and model.get("type") == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix") and model.get("unk_token") is None and not model.get("byte_fallback") and not model.get("ignore_merges")
            and [s.get("type") for s in steps].count("ByteLevel") == 1 and steps[-1].get("type") == "ByteLevel"
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in said.get("added_tokens", []))
        )
        self.usual = (said.get("normalizer") or {}).get("normalizers") == USUAL_NORMALIZER and steps[:-1] == [USUAL_SPLIT] and not steps[-1].get("use_regex", True) and not steps[-1].get("add_prefix_space", True)
        self.added = {t["content"]: t["id"] for t in said.get("added_tokens", [])}
        if self.fits:
            self._read(model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]], model.get("end_of_word_suffix") or "")

    def _read(self, vocab: dict[str, int], merges: list[list[str]], suffix: str) -> None:
        letters, size = byte_letters(), max([0, *vocab.values()]) + 1
        self.first = np.array([vocab.get(c, -1) for c in letters] + [vocab.get(c + suffix, -1) for c in letters], dtype=np.int64)
        """Token of each symbol: bytes 0 to 255 inside a word, 256 to 511 as the last byte of one."""
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        used: set[int] = set()
        for k, (a, b) in enumerate(merges):
            x, y, z = vocab.get(a, -1), vocab.get(b, -1), vocab.get(a + b, -1)
            if min(x, y, z) < 0 or self.rank[z] >= 0 or z in used or (x, y) in self.pair:
                self.fits = False
                return
            self.rank[z], self.left[z], self.right[z] = k, x, y
            self.pair[x, y] = (k, z)
            used |= {x, y}
        if (self.first < 0).any() or (self.rank[self.first] >= 0).any() or not self.pair:
            self.fits = False
            return
        keys = np.array([(x << 20) | y for x, y in self.pair], np.int64)
        self.ranks = Lookup(keys, np.array([k for k, _ in self.pair.values()], np.int64))
        self.made = np.array([z for _, z in self.pair.values()], np.int64)  # by rank
        # a token belongs to the trie if merging its own symbols gives it
        alone = self._compatible(self.left[self.made], self.right[self.made], self.rank[self.made])
        sound, symbols = set(self.first.tolist()), {}
        for symbol, token in enumerate(self.first[: 512 if suffix else 256].tolist()):
            symbols[token] = (symbol,)
        for token, fine in zip(self.made.tolist(), alone.tolist(), strict=True):
            x, y = int(self.left[token]), int(self.right[token])
            symbols[token] = symbols.get(x, ()) + symbols.get(y, ())
            if fine and x in sound and y in sound:
                sound.add(token)
        self.last = 256 if suffix else 0
        """What is added to the last symbol of a word."""
        self.edges: dict[int, int] = {}
        ends = [-1]
        for token in sorted(sound):
            node = 0
            for symbol in symbols[token]:
                if (node << 9 | symbol) not in self.edges:
                    self.edges[node << 9 | symbol] = len(ends)
                    ends.append(-1)
                node = self.edges[node << 9 | symbol]
            ends[node] = token
        self.ends = np.array(ends, np.int64)
        self.step = Lookup(np.fromiter(self.edges, np.int64, len(self.edges)), np.fromiter(self.edges.values(), np.int64, len(self.edges)))

    def _compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge over the border of a and b comes (before that rank)."""
        ok = np.ones(len(a), dtype=bool)
        which, a, b = np.arange(len(a)), a.copy(), b.copy()
        left_until = np.full(len(a), NEVER) if before is None else before.copy()  # a merge of this rank or later finds a hidden
        right_until = left_until.copy() if before is None else before - 1  # the last rank at which b still shows
        while len(which):
            rank = self.ranks((a << 20) | b)
            bad = (rank >= 0) & (rank < left_until) & (rank <= right_until)
            ok[which[bad]] = False
            in_a, in_b = self.rank[a], self.rank[b]
            more = ~bad & ((in_a >= 0) | (in_b >= 0))
            which, a, b, in_a, in_b, left_until, right_until = which[more], a[more], b[more], in_a[more], in_b[more], left_until[more], right_until[more]
            undo = in_a > in_b  # the later merge is undone first; of equal ones the right one is the later
            left_until, right_until = np.where(undo, in_a, left_until), np.where(undo, right_until, in_b)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return ok

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_compatible`` of each pair; equal pairs are looked at once."""
        found = pa.array((a << 20) | b).dictionary_encode()
        keys = found.dictionary.to_numpy()
        return self._compatible(keys >> 20, keys & ((1 << 20) - 1))[found.indices.to_numpy()]


def propose(rules: Rules, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Greedy longest matches: at each place of ``symbols`` where a proposed token begins, the token; elsewhere -1."""
    out = np.full(len(symbols), -1, np.int64)
    for k in np.flatnonzero(end - begin > LONG_WORD).tolist():
        run, at = symbols[begin[k] : end[k]].tolist(), 0
        while at < len(run):
            node, q, best, to = 0, at, -1, at
            while q < len(run) and (node := rules.edges.get(node << 9 | run[q], -1)) >= 0:
                q += 1
                if rules.ends[node] >= 0:
                    best, to = rules.ends[node], q
            out[begin[k] + at], at = best, to
    some = np.flatnonzero((end - begin <= LONG_WORD) & (end > begin))
    start, stop = begin[some].copy(), end[some]
    at, node, best, to = start.copy(), np.zeros(len(some), np.int64), np.full(len(some), -1, np.int64), start.copy()
    while len(start):
        inside = at < stop
        found = rules.step((node << 9) | np.where(inside, symbols[np.minimum(at, len(symbols) - 1)], 0))
        go = inside & (found >= 0)
        at, node = at + go, np.where(go, found, 0)
        token = np.where(go, rules.ends[node], -1)
        hit = token >= 0
        best, to = np.where(hit, token, best), np.where(hit, at, to)
        if not go.all():
            halt = ~go
            out[start[halt]] = best[halt]
            start = np.where(halt, to, start)
            at, best = np.where(halt, to, at), np.where(halt, -1, best)
            left = start < stop
            if not left.all():
                start, stop, at, node, best, to = start[left], stop[left], at[left], node[left], best[left], to[left]
    return out


def _heap_merge(rules: Rules, tokens: list[int]) -> list[int]:
    """Exact merging of one long word: lowest rank first, of equal ranks the left one."""
    n = len(tokens)
    after, before, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
    heap = [(rules.pair[p][0], k, p) for k, p in enumerate(zip(tokens, tokens[1:], strict=False)) if p in rules.pair]
    heapq.heapify(heap)
    while heap:
        _, k, held = heapq.heappop(heap)
        right = after[k]
        if not alive[k] or right < 0 or (tokens[k], tokens[right]) != held:
            continue
        tokens[k], alive[right], after[k] = rules.pair[held][1], False, after[right]
        if after[right] >= 0:
            before[after[right]] = k
        for lo, hi in ((before[k], k), (k, after[k])):
            if lo >= 0 and hi >= 0 and (pair := (tokens[lo], tokens[hi])) in rules.pair:
                heapq.heappush(heap, (rules.pair[pair][0], lo, pair))
    return [t for t, here in zip(tokens, alive, strict=True) if here]


def merge_exactly(rules: Rules, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all these words in a row, how many each has), by merging; short words step together, one merge of each a round."""
    n = len(begin)
    parts: list[tuple[np.ndarray, np.ndarray]] = []  # (words, token counts are taken from their tokens' word numbers)
    long = np.flatnonzero(end - begin > LONG_WORD)
    for k in long.tolist():
        done = np.array(_heap_merge(rules, rules.first[symbols[begin[k] : end[k]]].tolist()), np.int64)
        parts.append((np.full(len(done), k), done))
    short = np.flatnonzero(end - begin <= LONG_WORD)
    size = end[short] - begin[short]
    word, token = np.repeat(short, size), rules.first[symbols[_runs(begin[short], size)]]
    while len(word):
        rank = rules.ranks((token[:-1] << 20) | token[1:])
        rank = np.append(np.where((rank >= 0) & (word[:-1] == word[1:]), rank, NEVER), NEVER)
        heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        least = np.minimum.reduceat(rank, heads)
        runs = np.diff(np.append(heads, len(word)))
        busy = np.repeat(least < NEVER, runs)
        if not busy.all():
            parts.append((word[~busy], token[~busy]))
        hit = busy & (rank == np.repeat(least, runs))
        places = np.flatnonzero(hit)
        if not len(places):
            break
        places = places[np.append(True, word[places[1:]] != word[places[:-1]])]  # the leftmost of each word
        token[places] = rules.made[rank[places]]
        busy[places + 1] = False
        word, token = word[busy], token[busy]
    word, token = np.concatenate([w for w, _ in parts] or [np.zeros(0, np.int64)]), np.concatenate([t for _, t in parts] or [np.zeros(0, np.int64)])
    order = np.argsort(word, kind="stable")
    return token[order], np.bincount(word, minlength=n)


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each run, one run after another."""
    end = np.cumsum(size)
    return np.arange(int(end[-1]) if len(end) else 0) + np.repeat(first - (end - size), size)


class Codec:
    """A tokenizer file, ready to encode and decode columns of Arrow."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.rules = Rules(said | {"truncation": None, "padding": None})
        self.byte_of = np.zeros(0x200, np.uint8)
        self.byte_of[[ord(c) for c in byte_letters()]] = np.arange(256)
        self.marks = sorted((content.encode(), token) for content, token in self.rules.added.items() if content)
        self.exact_words = self.all_words = 0
        self._names: tuple[np.ndarray, np.ndarray] | None = None
        self.joins = said.get("decoder") is None

    # encoding

    def tokens_of_words(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all words in a row, how many each has): propose, verify, and merge what fails."""
        which, raw, word_end = W.named_codes(data, begin, end)
        word_begin = np.append(0, word_end)[:-1]
        symbols = raw.astype(np.int64)
        symbols[word_end - 1] += self.rules.last
        proposed = propose(self.rules, symbols, word_begin, word_end)
        places = np.flatnonzero(proposed >= 0)
        token, word = proposed[places], np.searchsorted(word_end, places, side="right")
        inner = word[:-1] == word[1:]
        bad = np.zeros(len(word_end), dtype=bool)
        bad[word[:-1][inner][~self.rules.compatible(token[:-1][inner], token[1:][inner])]] = True
        self.all_words += len(bad)
        count = np.bincount(word, minlength=len(word_end))
        if bad.any():
            failed = np.flatnonzero(bad)
            self.exact_words += len(failed)
            exact, sizes = merge_exactly(self.rules, symbols, word_begin[failed], word_end[failed])
            keep = ~bad[word]
            old_token = token[keep]
            count[failed] = sizes
            first = np.cumsum(count) - count
            token = np.empty(int(count.sum()), np.int64)
            token[_runs(first[failed], sizes)] = exact
            kept = np.flatnonzero(~bad)
            token[_runs(first[kept], count[kept])] = old_token  # in order of words
        first = np.cumsum(count) - count
        return token[_runs(first[which], count[which])], count[which]

    @staticmethod
    def _plain_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, row) of the words of lower-cased plain texts by the usual rule: contractions, letters, one digit, others."""
        n = len(data)
        kind = _CLASS[data]
        head = np.zeros(n + 1, dtype=bool)
        head[starts[starts < n]] = True
        head[n] = True
        edge = head[:n] | (kind != np.append(WHITE, kind[:-1])) | (kind == DIGIT)
        quote = np.flatnonzero((data == 0x27) & edge)
        if len(quote):
            padded, last = np.append(data, [0, 0, 0]).astype(np.uint8), np.append(head, [True, True])
            open_ = ~last[quote + 1]
            one, two = padded[quote + 1], padded[quote + 2]
            short = open_ & np.isin(one, np.frombuffer(b"stmd", np.uint8))
            code = one.astype(np.int64) << 8 | two
            wide = open_ & ~short & ~last[quote + 2] & np.isin(code, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])
            edge[quote[short | wide] + 1] = False  # the apostrophe and its letters are one word, what follows is another
            for more, width in ((short, 2), (wide, 3)):
                after = quote[more] + width
                edge[after[after < n]] = True
        begin = np.flatnonzero(edge)
        end = np.append(begin[1:], n)
        words = kind[begin] != WHITE
        begin, end = begin[words], end[words]
        return begin, end, np.searchsorted(starts, begin, side="right") - 1

    def _library_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all words in a row, size of each, row, its token if it is an added one or -1): as the library normalises and cuts."""
        pieces, sizes, rows, added = [], [], [], []

        def cut(row: int, text: str) -> None:
            if text:
                normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    if piece:
                        pieces.append(piece)
                        sizes.append(len(piece))
                        rows.append(row)
                        added.append(-1)

        for row, text in enumerate(texts):
            at = 0
            while self.marks:
                found = [(p, -len(m), token) for m, token in self.marks if (p := text.find(m.decode(), at)) >= 0]
                if not found:
                    break
                place, width, token = min(found)
                cut(row, text[at:place])
                for list_, value in ((sizes, 0), (rows, row), (added, token)):
                    list_.append(value)
                at = place - width
            cut(row, text[at:])
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        return self.byte_of[codes], np.array(sizes, np.int64), np.array(rows, np.int64), np.array(added, np.int64)

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        n = len(offsets) - 1
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * n
        bytes_ = data.tobytes()
        if not self.rules.fits:
            texts = [bytes_[offsets[k] : offsets[k + 1]].decode() for k in range(n)]
            return [np.array(x.ids, np.uint32) for x in self.library.encode_batch(texts, add_special_tokens=False)]
        whole = np.zeros(n, dtype=bool)
        if self.rules.usual:
            odd = np.zeros(len(data) + 1, np.int64)
            np.cumsum(_STRANGE[data] | (np.append(0, data[:-1]) == 0xC3) & ((data == 0x97) | (data == 0xB7)), out=odd[1:])
            whole = odd[offsets[1:]] > odd[offsets[:-1]]
            for mark, _ in self.marks:
                place = bytes_.find(mark)
                while place >= 0:
                    whole[np.searchsorted(offsets, place, side="right") - 1] = True
                    place = bytes_.find(mark, place + 1)
        else:
            whole[:] = True
        if not whole.all():
            lower = W.LOWER[data]
            after = np.flatnonzero(data[:-1] == 0xC3) + 1
            after = after[(data[after] >= 0x80) & (data[after] <= 0x9E)]
            lower[after] += 0x20
            begin, end, row = self._plain_words(lower, offsets[:-1])
            mine = ~whole[row]
            self._put(out, lower, begin[mine], end[mine], row[mine], n, ~whole)
        if whole.any():
            rows = np.flatnonzero(whole)
            letters, size, row, added = self._library_words([bytes_[offsets[k] : offsets[k + 1]].decode() for k in rows.tolist()])
            end = np.cumsum(size)
            self._put(out, letters, end - size, end, rows[row] if len(row) else row, n, whole, added)
        return out

    def _put(self, out: list, data: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray, n: int, mine: np.ndarray, added: np.ndarray | None = None) -> None:
        """The ids of these words (in order of rows) into ``out``, for the rows that are ``mine``."""
        if not len(row):
            return
        words = end > begin if added is None else added < 0
        some, count = self.tokens_of_words(data, begin[words], end[words]) if words.any() else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if added is None or words.all():
            ids, sizes = some, count
        else:
            sizes = np.ones(len(row), np.int64)
            sizes[words] = count
            first = np.cumsum(sizes) - sizes
            ids = np.empty(int(sizes.sum()), np.int64)
            ids[first[~words]] = added[~words]
            ids[_runs(first[words], count)] = some
        per_row = np.bincount(row, weights=sizes, minlength=n).astype(np.int64)
        for k, part in enumerate(np.split(ids.astype(np.uint32), np.cumsum(per_row)[:-1])):
            if mine[k]:
                out[k] = part

    def encode_column(self, column) -> list[np.ndarray]:
        """The ids of each text of an Arrow column; a null counts as an empty text."""
        raw, offsets = W.buffers(column)
        out: list[np.ndarray] = []
        for lo, hi in W.slices(offsets, SLICE_BYTES):
            out += self._slice(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        return out

    # decoding

    def _tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of every token's text with a blank behind it, in a row, and where each ends); an id without a token has none."""
        if self._names is None:
            vocab = self.library.get_vocab(with_added_tokens=True)
            names = [b""] * (max([-1, *vocab.values()]) + 1)
            for text, token in vocab.items():
                names[token] = text.encode() + b" "
            self._names = np.frombuffer(b"".join(names), np.uint8), np.cumsum([0, *map(len, names)])
        return self._names

    def decode_rows(self, rows: list[np.ndarray]) -> list[str]:
        """The text of each row of ids."""
        if not self.joins:
            return self.library.decode_batch([r.tolist() for r in rows], skip_special_tokens=False)
        names, ends = self._tokens()
        out = []
        for ids in rows:
            ids = ids[ids < len(ends) - 1].astype(np.int64)
            text = names[_runs(ends[ids], ends[ids + 1] - ends[ids])].tobytes()
            out.append(text[:-1].decode())
        return out


_codecs: dict[str, Codec] = {}


def codec_for(path: str) -> Codec:
    """One codec a process and file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _bytes_column(rows: list[np.ndarray]) -> pa.Array:
    """Ids as little-endian unsigned 32-bit integers."""
    return pa.array([np.ascontiguousarray(r, dtype="<u4").tobytes() for r in rows], pa.binary())


@lean
def _encoded(batches, path: str):
    codec = codec_for(path)
    for batch in batches:
        text, _ = W.buffers(batch.column(0))
        rows = max(1, min(batch.num_rows, int(batch.num_rows * (4 * SLICE_BYTES) / max(1, len(text)))))
        for lo in range(0, batch.num_rows, rows):
            sub = batch.slice(lo, rows)
            ids = codec.encode_column(sub.column(0))
            yield pa.RecordBatch.from_arrays([*sub.columns[1:], _bytes_column(ids), pa.array([len(x) for x in ids], pa.int64())], [*sub.schema.names[1:], "ids", "n_tokens"])


@lean
def _decoded(batches, path: str):
    codec = codec_for(path)
    for batch in batches:
        cells = batch.column(0)
        for lo in range(0, batch.num_rows, 256):
            sub = cells.slice(lo, 256)
            texts = codec.decode_rows([np.frombuffer(x.as_buffer(), "<u4") if x.is_valid and len(x.as_buffer()) else np.zeros(0, np.uint32) for x in sub])
            rest = batch.slice(lo, 256).columns[1:]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], [*batch.schema.names[1:], "decoded"])


def _schema(frame: DataFrame, keep: list[str], *more: T.StructField) -> T.StructType:
    return T.StructType([*(frame.schema[c] for c in keep), *more])


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens`` of each text; no shuffle.

    ``path`` is the tokenizer file on every machine."""
    kept = list(keep)
    picked = docs.select(F.col(text).alias("__text"), *kept)
    return picked.mapInArrow(lambda it: _encoded(it, path), _schema(picked, kept, T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())))


def decode(frame: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``decoded``, the text of each row's ids (as ``encode`` writes them); no shuffle."""
    kept = list(keep)
    picked = frame.select(F.col(ids).alias("__ids"), *kept)
    return picked.mapInArrow(lambda it: _decoded(it, path), _schema(picked, kept, T.StructField("decoded", T.StringType())))
