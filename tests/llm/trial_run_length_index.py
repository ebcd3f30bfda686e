"""Trial of operator 3's named method on one core: python tests/llm/trial_run_length_index.py [bytes] [table folder].

Builds the run-length compressed Burrows-Wheeler transform of the first bytes of a documents table (suffixes sorted by their first 128 bytes:
eight bytes at once, then only groups that are not settled, doubling), and streams other documents of the table backwards
against it, many at once.  Prints CPU seconds a GB of text for the build, runs a byte, and nanoseconds a byte for a rank in one index.
"""

import sys
import time

import numpy as np
import pyarrow.parquet as pq


def suffixes(data: np.ndarray, width: int = 128) -> np.ndarray:
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key |= padded[i : n + i] << np.uint64(56 - 8 * i)
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])
    h = 8
    while h < width:
        rank = np.empty(n, np.int64)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        open_ = np.flatnonzero(~new | ~np.append(new[1:], True))  # groups of more than one
        if not len(open_):
            break
        own = order[open_]
        after = np.where(own + h < n, rank[np.minimum(own + h, n - 1)], -1)
        by = np.lexsort((after, rank[own]))
        order[open_] = own[by]
        a, b = rank[own][by], after[by]
        new[open_] = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        h *= 2
    return order


class Runs:
    """Ranks in a run-length compressed transform."""

    def __init__(self, bwt: np.ndarray):
        head = np.flatnonzero(np.append(True, bwt[1:] != bwt[:-1]))
        self.head, self.byte, self.size = head, bwt[head], np.diff(np.append(head, len(bwt)))
        self.first = np.append(0, np.cumsum(np.bincount(bwt, minlength=256)))[:256]
        by = np.argsort(self.byte, kind="stable")
        self.start = np.searchsorted(self.byte[by], np.arange(257))
        self.places = self.byte[by].astype(np.int64) * (len(bwt) + 1) + head[by]  # sorted: byte, then place
        before = np.cumsum(self.size[by]) - self.size[by]
        self.before = before - np.append(before, 0)[self.start[self.byte[by]]]
        self.sizes, self.n = self.size[by], len(bwt)

    def rank(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each byte c stands before a place."""
        k = np.searchsorted(self.places, c.astype(np.int64) * (self.n + 1) + at, "left") - 1
        ok = k >= self.start[c]
        k = np.maximum(k, 0)
        inside = np.minimum(at - (self.places[k] - c.astype(np.int64) * (self.n + 1)), self.sizes[k])
        return np.where(ok, self.before[k] + inside, 0)


def main() -> None:
    size = int(sys.argv[1]) if len(sys.argv) > 1 else 4 << 20
    texts = pq.read_table(sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/check_s/documents.parquet", columns=["text"])["text"].to_pylist()
    whole = np.frombuffer("\0".join(t or "" for t in texts).encode(), np.uint8)
    data, others = whole[:size], whole[size : size + (4096 << 8)]
    began = time.process_time()
    order = suffixes(data)
    runs = Runs(data[order - 1])
    build = time.process_time() - began
    streams = others[: len(others) // 4096 * 4096].reshape(4096, -1)
    low, high = np.zeros(4096, np.int64), np.full(4096, len(data), np.int64)
    began = time.process_time()
    for c in streams.T[::-1]:
        low, high = runs.first[c] + runs.rank(c, low), runs.first[c] + runs.rank(c, high)
        lost = low >= high
        low, high = np.where(lost, 0, low), np.where(lost, len(data), high)
    each = (time.process_time() - began) / streams.size
    print(f"{size} bytes: build {build / size * 1e9:.0f} CPU s a GB of text, {len(runs.head) / size:.3f} runs a byte, {each * 1e9:.0f} ns a byte for both ends of a range in one index")


if __name__ == "__main__":
    main()
