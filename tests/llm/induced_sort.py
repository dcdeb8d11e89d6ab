"""A measurement behind the README's note on op6: external induced sorting of one shard, with queues on disk.

python tests/llm/induced_sort.py DOCUMENTS MEGABYTES prints CPU seconds and bytes of queue files for so much text. The
text itself stays in memory and common-prefix values are left out, so that the figures are lower bounds.
"""

import sys
import tempfile
import time

import numpy as np


class Queue:
    """A queue of positions for each character, first in first out, whose entries go to files."""

    def __init__(self, folder, size, buffered=1 << 16):
        self.folder, self.buffered = folder, buffered
        self.held, self.n, self.files = [[] for _ in range(size)], [0] * size, [None] * size
        self.bytes = 0

    def put(self, keys, positions):
        order = np.argsort(keys, kind="stable")
        keys, positions = keys[order], positions[order]
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                self.add(int(keys[a]), positions[a:b])

    def add(self, key, positions):
        self.held[key].append(positions)
        self.n[key] += len(positions)
        if self.n[key] >= self.buffered:
            self.flush(key)

    def flush(self, key):
        if self.files[key] is None:
            self.files[key] = tempfile.TemporaryFile(dir=self.folder)  # noqa: SIM115
        for x in self.held[key]:
            x.tofile(self.files[key])
            self.bytes += x.nbytes
        self.held[key], self.n[key] = [], 0

    def take(self, key):
        """All entries of a key, in order."""
        if self.files[key] is None:
            return np.concatenate(self.held[key]) if self.held[key] else np.zeros(0, np.int64)
        self.flush(key)
        self.files[key].seek(0)
        return np.fromfile(self.files[key], np.int64)


def smaller(x):
    """Of each suffix whether the next one is greater (type S); the last one is the least of all."""
    out = np.zeros(len(x), bool)
    out[-1] = True
    change = np.flatnonzero(x[1:] != x[:-1])
    up = x[change] < x[change + 1]
    ends = np.append(change, len(x) - 1)
    out[:] = np.repeat(np.append(up, True), np.diff(np.concatenate([[-1], ends])))
    return out


def induced(x, lms, small, folder, stats):
    """All suffixes in order, from the sorted LMS suffixes: first the type L ones, upwards, then the type S ones, downwards."""
    size = int(x.max()) + 1
    left, right = Queue(folder, size), Queue(folder, size)
    start = np.argsort(x[lms], kind="stable")
    heads = np.searchsorted(x[lms][start], np.arange(size + 1))
    for c in range(size):
        part = left.take(c)
        while len(part):  # entries of a run of one character follow one another
            before = part[part > 0] - 1
            before = before[~small[before]]
            same = x[before] == c
            left.put(x[before[~same]], before[~same])
            if same.any():
                left.add(c, before[same])
            part = before[same]
        seeds = lms[start[heads[c] : heads[c + 1]]]
        before = seeds[seeds > 0] - 1
        before = before[~small[before]]
        left.put(x[before], before)
    out = []
    for c in range(size - 1, -1, -1):
        part = right.take(c)
        whole = [part]
        while len(part):
            before = part[part > 0] - 1
            before = before[small[before]]
            same = x[before] == c
            right.put(x[before[~same]], before[~same])
            part = before[same]
            whole.append(part)
        ls = left.take(c)[::-1]
        before = ls[ls > 0] - 1
        before = before[small[before]]
        right.put(x[before], before)
        s = np.concatenate(whole)
        out.append(np.concatenate([s, [len(x) - 1]]) if c == x[-1] else s)
        out.append(ls)
    stats["bytes"] += left.bytes + right.bytes
    return np.concatenate(out)[::-1]


def suffix_array(x, folder, stats):
    """x ends with its only least value."""
    small = smaller(x)
    lms = np.flatnonzero(small & np.append(False, ~small[:-1]))
    stats["lms"].append(len(lms) / len(x))
    if len(lms) < 2:
        return induced(x, lms, small, folder, stats)
    rough = induced(x, lms, small, folder, stats)
    order = rough[np.isin(rough, lms, assume_unique=True)]
    ends = np.append(lms[1:], len(x) - 1)
    length = ends - lms
    row = np.searchsorted(lms, order)
    new = np.ones(len(order), bool)
    for k in range(int(length.max()) + 1):  # compared character by character
        a, b = order[:-1] + k, order[1:] + k
        inside = (k <= length[row[:-1]]) & (k <= length[row[1:]])
        if k == 0:
            differ = np.zeros(len(order) - 1, bool)
        if not inside.any():
            break
        differ[inside] |= (x[a[inside]] != x[b[inside]]) | (small[a[inside]] != small[b[inside]])
    new[1:] = differ | (length[row[:-1]] != length[row[1:]])
    names = np.zeros(len(lms), np.int64)
    names[row] = np.cumsum(new) - 1
    if names.max() + 1 < len(lms):
        sorted_lms = lms[suffix_array(names, folder, stats)]
    else:
        sorted_lms = lms[np.argsort(names)]
    return induced(x, sorted_lms, small, folder, stats)


def main(path, megabytes):
    import pyarrow.dataset

    texts, size = [], 0
    for batch in pyarrow.dataset.dataset(path).to_batches(columns=["text"]):
        for t in batch.column(0):
            texts.append((t.as_py() or "").encode())
            size += len(texts[-1])
        if size >= megabytes << 20:
            break
    x = np.frombuffer(b"\x01".join(texts)[: megabytes << 20].replace(b"\0", b"\x01") + b"\0", np.uint8).astype(np.int64)
    stats = {"bytes": 0, "lms": []}
    began = time.process_time()
    with tempfile.TemporaryDirectory() as folder:
        suffix_array(x, folder, stats)
    print(f"{len(x) / 1e6:.0f} MB of text: {(time.process_time() - began) / len(x) * 1e9:.0f} CPU seconds a GB of text, {stats['bytes'] / len(x):.1f} bytes of queue files a byte of text, {stats['lms'][0]:.2f} LMS suffixes a byte, {len(stats['lms'])} levels")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]))
