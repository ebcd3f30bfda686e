"""Operator 1: SentencePiece encoding and decoding by a batched numpy Viterbi.

A text is cut into words that no piece can span (a piece has its space mark only in front; models whose pieces never join
letters with other characters are cut there too); every worker segments each distinct word once.  Words of equal length advance together: at every end position the substrings of each length are hashed,
the hashes probe the sorted piece keys, and vectorised maxima over the candidate last pieces store scores and backpointers.

Unigram models add piece scores.  BPE models need more than a sum: a segmentation is what the merges give if and only if every
neighbouring pair of pieces is stable, that is, no merge across their seam comes before the merges that build the two.  So the
transition score of an unstable pair is minus infinity, and exactly one path to each end survives.  Stability of all pairs met is decided at
once, by undoing the two pieces' own merges, latest first.  Ids equal the sentencepiece library's (tested), for both kinds.

A word of more than LONG characters (text without any break) goes alone: the substrings of all its ends are hashed and looked up together, pairs of
pieces that meet are decided together, block by block, and only the choice of the best is left to each end.

Runs of spaces follow the library: the last space goes with the word if its first piece takes it, the rest is merged from the left.
Characters without a piece become byte pieces.  Null texts count as empty and have no ids.  Every row is kept, also rows
with a null or repeated doc_id; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import spread
from voxlake.plans.workers import lean

SPACE = "▁"
KNOWN = 400_000  # words that a task remembers
LONG = 1000  # characters; longer words are segmented alone
LEARNED = 2_400  # texts whose words are learned at once
ENDS = 1 << 15  # ends of a long word that are looked up at once
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LETTER = "[^\\W\\d_]"
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+")
_FINE = re.compile(f"{SPACE}*{_LETTER}+|{SPACE}*(?:[^{SPACE}\n\\w]|[\\d_])+|\n|{SPACE}+")  # cut between letters and others too


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of equally long words, spread over 64 bits."""
    x = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64) + np.uint64(1)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


class Model:
    """Pieces by hash, with what stability needs of each: rank of its merge and the two parts of its last merge."""

    def __init__(self, pieces: list[str], scores: list[float], plain: list[bool], byte_ids: list[int], unigram: bool, unknown: int):
        self.unigram, self.byte_ids, self.unknown, self.texts = unigram, byte_ids, unknown, pieces
        self.powers = _powers(64)
        own = np.array([i for i, p in enumerate(pieces) if plain[i] and set(p) != {SPACE} or p == SPACE])
        self.longest = max(len(pieces[i]) for i in own)
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.hash = np.zeros(len(pieces), np.uint64)
        for n in np.unique(self.size[own]):
            ids = own[self.size[own] == n]
            self.hash[ids] = self._hash(_codes([pieces[i] for i in ids]))
        order = np.argsort(self.hash[own], kind="stable")
        self.ids, self.keys = own[order], self.hash[own][order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.scores = np.array(scores)
        self.rank = np.where(self.size > 1, -self.scores, -np.inf)
        self.left = self.right = np.full(len(pieces), -1)
        seam = re.compile(f"{_LETTER}[^{SPACE}\\n](?<!{_LETTER})|(?!{_LETTER})[^{SPACE}]{_LETTER}")
        self.chunks = (_CHUNK if any(seam.search(pieces[i]) for i in own) else _FINE).findall
        self.name = hashlib.sha256(repr((pieces, scores, plain, byte_ids, unigram, unknown)).encode()).hexdigest()
        self.runs = {p: i for i, p in enumerate(pieces) if set(p) == {SPACE}}
        if not unigram:
            self._split()

    def _hash(self, codes: np.ndarray) -> np.ndarray:
        return (codes * self.powers[: codes.shape[1]][::-1]).sum(axis=1, dtype=np.uint64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece of each hash, or -1."""
        out = np.full(len(keys), -1)
        near = np.flatnonzero(self.maybe[(keys >> np.uint64(44)).astype(np.int64)])  # most substrings start no key
        key = keys[near]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        out[near[hit]] = self.ids[at[hit]]
        return out

    def _split(self) -> None:
        """The two parts of every piece's last merge; pieces that merges cannot reach leave the index."""
        self.left, self.right = self.left.copy(), self.right.copy()
        reached = self.size == 1
        for n in range(2, self.longest + 1):
            ids = self.ids[self.size[self.ids] == n]
            if not len(ids):
                continue
            codes = _codes([self.texts[i] for i in ids])
            for k in range(1, n):
                a, b = self.find(self._hash(codes[:, :k])), self.find(self._hash(codes[:, k:]))
                ok = np.flatnonzero((a >= 0) & (b >= 0))
                ok = ok[reached[a[ok]] & reached[b[ok]]]
                ok = ok[self.stable(a[ok], b[ok], own=True)]
                self.left[ids[ok]], self.right[ids[ok]] = a[ok], b[ok]
                reached[ids[ok]] = True
        keep = reached[self.ids]
        self.ids, self.keys = self.ids[keep], self.keys[keep]

    def stable(self, a: np.ndarray, b: np.ndarray, own: bool = False) -> np.ndarray:
        """Whether merges leave each pair a, b side by side; own: up to the merge of the pair itself.  Below zero: an unknown character."""
        x, y, out = a.copy(), b.copy(), np.ones(len(a), bool)
        limit_x, limit_y = np.full(len(a), np.inf), np.full(len(a), np.inf)
        live = np.flatnonzero((a >= 0) & (b >= 0))
        first = True
        while len(live):
            p, q = x[live], y[live]
            both = self.find(self.hash[p] * self.powers[self.size[q]] + self.hash[q])
            r = np.where(both >= 0, self.rank[both], np.inf)
            if not (own and first):
                out[live[(r < limit_x[live]) & (r <= limit_y[live]) & (both >= 0)]] = False
            first = False
            more = out[live] & ((self.size[p] > 1) | (self.size[q] > 1))
            live, p, q = live[more], p[more], q[more]
            undo_x = self.rank[p] > self.rank[q]
            i, j = live[undo_x], live[~undo_x]
            limit_x[i], x[i] = self.rank[x[i]], self.right[x[i]]
            limit_y[j], y[j] = self.rank[y[j]], self.left[y[j]]
        return out

    def _equal(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces of equally long words (-1 for a character without a piece), and how many each has."""
        n, codes = len(words[0]), _codes(words)
        m = len(words)
        low = float(self.scores[self.ids].min()) - 10
        prefix = np.zeros((n + 1, m), np.uint64)
        for i in range(n):
            prefix[i + 1] = prefix[i] * _BASE + codes[:, i]
        best, back = np.full((n + 1, m), -np.inf, np.float32), np.zeros((n + 1, m), np.int64)
        last = np.full((n + 1, m), -1)
        best[0] = 0
        for end in range(1, n + 1):
            for size in range(min(self.longest, end), 0, -1):  # ties: the longest last piece, sums in single precision, as the library has it
                piece = self.find(prefix[end] - prefix[end - size] * self.powers[size])
                ok = np.flatnonzero(((piece >= 0) | (size == 1)) & np.isfinite(best[end - size]))
                if not len(ok):
                    continue
                gain = np.where(piece[ok] >= 0, self.scores[piece[ok]] if self.unigram else 0.0, low if self.unigram else 0.0).astype(np.float32)
                if not self.unigram and end > size:
                    pairs, where = np.unique(last[end - size, ok] * np.int64(1 << 32) + piece[ok], return_inverse=True)
                    fits = self.stable((pairs + 1) >> 32, pairs - (((pairs + 1) >> 32) << 32))[where]
                    ok, gain = ok[fits], gain[fits]
                total = best[end - size, ok] + gain
                better = total > best[end, ok]
                ok = ok[better]
                best[end, ok], back[end, ok], last[end, ok] = total[better], size, piece[ok]
        taken, at, live = [], np.full(m, n), np.arange(m)
        while len(live):
            row = np.full(m, -2)
            row[live] = last[at[live], live]
            taken.append(row)
            at[live] -= back[at[live], live]
            live = live[at[live] > 0]
        paths = np.stack(taken[::-1]).T
        used = paths != -2
        return paths[used], used.sum(axis=1)

    def _alone(self, word: str) -> np.ndarray:
        """All pieces of one long word, as _equal would find them."""
        n, code = len(word), _codes([word])[0]
        up, down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b)]), dtype=np.uint64) for b in (_BASE, _BACK))
        total = np.concatenate([[np.uint64(0)], np.cumsum(code * down[:n], dtype=np.uint64)])
        best, last, back = [0.0] + [-np.inf] * n, [-1] * (n + 1), [0] * (n + 1)
        best[0] = np.float32(0)
        low, fits = np.float32(float(self.scores[self.ids].min()) - 10), {}
        scores = self.scores.astype(np.float32)
        ending: dict[int, list[int]] = {}  # pieces that end at each place of the block before
        for begin in range(0, n, ENDS):
            ends = np.arange(begin + 1, min(n, begin + ENDS) + 1)
            found: list[list[tuple[int, int]]] = [[] for _ in ends]
            for size in range(self.longest, 0, -1):
                e = ends[ends >= size]
                piece = self.find((total[e] - total[e - size]) * up[e - 1])
                for i in np.flatnonzero((piece >= 0) | (size == 1)).tolist():
                    found[e[i] - begin - 1].append((size, int(piece[i])))
            if not self.unigram:
                for e, own in zip(ends.tolist(), found, strict=True):
                    ending[e] = [p for _, p in own]
                pairs = {(a, b) for e, own in zip(ends.tolist(), found, strict=True) for size, b in own if e > size for a in ending[e - size]} - fits.keys()
                if pairs:
                    a, b = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
                    fits.update(zip(zip(a.tolist(), b.tolist(), strict=True), self.stable(a, b).tolist(), strict=True))
                ending = {e: v for e, v in ending.items() if e > ends[-1] - self.longest}
            for e, own in zip(ends.tolist(), found, strict=True):
                for size, piece in own:  # ties: the longest last piece
                    before = best[e - size]
                    if before == -np.inf or not self.unigram and e > size and not fits[last[e - size], piece]:
                        continue
                    value = before + (scores[piece] if piece >= 0 else low) if self.unigram else np.float32(0)
                    if value > best[e]:
                        best[e], back[e], last[e] = value, size, piece
        out, at = [], n
        while at:
            out.append(last[at])
            at -= back[at]
        return np.array(out[::-1], np.int64)

    def _run(self, n: int) -> list[int]:
        """Pieces of n space marks: equal ranks merge from the left."""
        parts = [SPACE] * n
        while True:
            ranks = [(-self.scores[self.runs[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.runs]
            if not ranks:
                return [self.runs[p] for p in parts]
            i = min(ranks)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words (marks in front allowed), and how many each has."""
        spaces = np.fromiter((len(w) - len(w.lstrip(SPACE)) if w[0] == SPACE else 0 for w in words), np.int64, len(words))
        length = np.fromiter(map(len, words), np.int64, len(words))
        odd = np.flatnonzero((spaces > 1) | (spaces == length))
        core = words
        if len(odd):
            core = list(words)
            for i in odd.tolist():
                core[i] = words[i][spaces[i] - 1 :] if spaces[i] < length[i] else SPACE
        cut = np.where((spaces > 1) & (spaces < length), length - spaces + 1, np.where(spaces == length, 1, length))
        order = np.argsort(cut, kind="stable")
        parts, sizes = [], np.zeros(len(words), np.int64)
        at = 0
        while at < len(order):
            n = int(cut[order[at]])
            stop = min(int(np.searchsorted(cut[order], n, "right")), at + max(1, 400_000 // n))
            if n > LONG:
                stop = at + 1
                flat = self._alone(core[order[at]])
                count = len(flat)
            else:
                flat, count = self._equal([core[i] for i in order[at:stop].tolist()])
            parts.append(flat)
            sizes[order[at:stop]] = count
            at = stop
        flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
        placed = sizes[order]
        start = np.cumsum(placed) - placed
        where = np.empty(len(words), np.int64)
        where[order] = start
        unknown = np.unique(np.searchsorted(start, np.flatnonzero(flat < 0), "right") - 1) if len(flat) else []
        special = {int(i): self._finish(words[i], int(spaces[i]), flat[where[i] : where[i] + sizes[i]].tolist()) for i in {*odd.tolist(), *order[unknown].tolist()}}
        out = flat[np.repeat(where, sizes) + spread(sizes)]
        if special:
            bound, whole, done = np.append(0, np.cumsum(sizes)), [], 0
            for i in sorted(special):
                whole += [out[done : bound[i]], np.array(special[i], np.int64)]
                done, sizes[i] = bound[i + 1], len(special[i])
            out = np.concatenate([*whole, out[done:]])
        return out.astype(np.int32), sizes

    def _finish(self, word: str, spaces: int, path: list[int]) -> list[int]:
        """Ids of a word with a run of marks in front, or with characters that have no piece."""
        if spaces == len(word):
            return self._run(spaces)
        ids, at = [], max(0, spaces - 1)
        if spaces > 1:
            alone = path[0] >= 0 and self.texts[path[0]] == SPACE
            ids, path, at = self._run(spaces if alone else spaces - 1), path[1:] if alone else path, spaces if alone else spaces - 1
        for p in path:
            if p >= 0:
                ids.append(p)
                at += len(self.texts[p])
            else:
                ids += [self.byte_ids[b] for b in word[at].encode()] if self.byte_ids else [self.unknown]
                at += 1
        return ids

    def decode(self, ids: np.ndarray, table: list[bytes]) -> bytes:
        text = b"".join(map(table.__getitem__, ids.tolist()))
        return text[1:] if text.startswith(b" ") else text

    def table(self) -> list[bytes]:
        """Bytes of every piece when decoded."""
        out = [p.replace(SPACE, " ").encode() for p in self.texts]
        for b, i in enumerate(self.byte_ids):
            out[i] = bytes([b])
        return out


def load(path: str) -> Model:
    """The model file through the library's reader (pieces and scores); its segmentation is not used."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = range(sp.get_piece_size())
    plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in n]
    bytes_ = [i for i in n if sp.is_byte(i)]
    with open(path, "rb") as f:
        kind = model_type(f.read())
    return Model([sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n], plain, bytes_ if len(bytes_) == 256 else [], kind == 1, sp.unk_id())


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + n]
            at += n


def model_type(data: bytes) -> int:
    """1 unigram, 2 BPE: field 3 of the trainer's settings (field 2 of the model)."""
    settings = dict(_fields(next((v for k, v in _fields(data) if k == 2), b"")))
    return int(settings.get(3, 1))


class Encoder:
    """Encodes texts; remembers the ids of words."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.words: dict[str, int] = {}
        self.flat, self.start = np.empty(0, np.int32), np.zeros(1, np.int64)

    def learn(self, texts: Iterator[list[str]]) -> None:
        """Segments all words of some lists of texts that are not known yet, together."""
        if len(self.words) > KNOWN:
            self._clear()
        seen: set[str] = set()
        for part in texts:
            for t in part:
                seen.update(self.model.chunks(SPACE + t.replace(" ", SPACE)) if t else ())
        new = list(seen - self.words.keys())
        if new:
            ids, sizes = self.model.segment(new)
            self.words.update(zip(new, range(len(self.words), len(self.words) + len(new)), strict=True))
            self.flat = np.concatenate([self.flat, ids])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of each text; the words have been learned."""
        chunks = [self.model.chunks(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        at = np.fromiter((i for c in chunks for i in map(self.words.__getitem__, c)), np.int64, counts.sum())
        sizes = self.start[at + 1] - self.start[at]
        ids = self.flat[np.repeat(self.start[at], sizes) + spread(sizes)]
        bound = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
        return ids, np.diff(bound)


def encode_decode(docs: DataFrame, model: Model, with_ids: bool = True, with_text: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip, ids, decoded) of every row; round_trip: the decoded text is the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is the vocabulary's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        encoder = Encoder(model)
        table = model.table()
        for batch in batches:
            for i in range(0, batch.num_rows, 300):
                if i % LEARNED == 0:
                    some = batch.column(1).slice(i, LEARNED)
                    encoder.learn([t or "" for t in some.slice(k, 300).to_pylist()] for k in range(0, len(some), 300))
                part = batch.slice(i, 300)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids, sizes = encoder.encode(texts)
                off = np.append(0, np.cumsum(sizes))
                crc, same, decoded = [], [], []
                for k, text in enumerate(texts):
                    own = ids[off[k] : off[k + 1]]
                    crc.append(zlib.crc32(own.astype("<u4").tobytes()))
                    back = model.decode(own, table)
                    same.append(back == text.replace(SPACE, " ").encode())
                    decoded.append(back.decode("utf-8", "replace") if with_text else None)
                listed = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids)) if with_ids else pa.nulls(len(texts), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), pa.array(crc, pa.int64()), pa.array(same, pa.bool_()), listed, pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_crc32", "round_trip", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lean(run), "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, ids array<int>, decoded string")
