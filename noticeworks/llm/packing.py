"""Vector bin packing of token sequences under several limits at once.

A sequence has limits on tokens, on segments (pieces of documents) and on loss-bearing tokens.
Each task streams its documents into a pool. Whole sequences of long documents leave at once;
what remains of every document is an item. A bin takes, as long as any item fits, the item with
the largest weighted dot product of its demand and the room left in the bin; items of one demand
are one class, which is scored once, so that many tiny documents cost no more than one. When none
fits any more, an item is cut to fill the bin to the last token, and its rest stays in the pool. The last
bin of a task is cut at powers of two, which need no padding. Nothing is shuffled.

Defined results: a null text is an empty document of one id, the end id; repeated rows are
documents of their own; an empty table gives an empty table. Sequence ids are unique in a run;
they follow from the places of rows in the files.
"""

from __future__ import annotations

import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame

from noticeworks.llm.common import columns
from noticeworks.llm.tokens import encoder

LENGTH = 2048           # tokens of a sequence
SEGMENTS = 256          # pieces in a sequence at most
END = 1                 # id that ends a document
POOL = 2_000_000        # tokens that a task holds while it packs

SCHEMA = (
    "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long")


class Classes:
    """Items by demand, (tokens, 1, loss-bearing tokens): the demands in an array, their items in stacks."""

    def __init__(self, pairs):
        import numpy as np

        self.stacks: dict[tuple, list] = {}
        for need, item in pairs:
            self.stacks.setdefault(need, []).append(item)
        self.keys = list(self.stacks)
        self.needs = np.array(self.keys, float)
        self.n = len(self.keys)
        self.total = np.array([len(s) for s in self.stacks.values()], float) @ self.needs

    def best(self, weights, room=None):
        """The place of the demand with the largest dot product, of those that fit."""
        import numpy as np

        needs = self.needs[:self.n]
        score = needs @ weights
        if room is not None:
            score = np.where((needs <= room).all(axis=1), score, -1.0)
        i = int(score.argmax())
        return i if score[i] >= 0 else None

    def take(self, i):
        """One item of a demand; the last demand takes the place of one that is used up."""
        key, need = self.keys[i], self.needs[i].copy()
        item = self.stacks[key].pop()
        if not self.stacks[key]:
            del self.stacks[key]
            self.n -= 1
            self.keys[i], self.needs[i] = self.keys[self.n], self.needs[self.n]
        return need, item

    def put(self, key, item):
        import numpy as np

        if key not in self.stacks:
            self.stacks[key] = []
            if self.n == len(self.keys):
                self.keys.append(key)
                self.needs = np.vstack([self.needs, [key]])
            self.keys[self.n], self.needs[self.n] = key, key
            self.n += 1
        self.stacks[key].append(item)


class Packer:
    """Packs the documents of one task; ``emit`` gets the pieces of a sequence."""

    def __init__(self, emit, length=LENGTH, segments=SEGMENTS, loss=None):
        self.emit, self.length, self.segments, self.loss = emit, length, segments, loss or length
        self.items: list[tuple[int, int, int]] = []  # document, start, end
        self.free_from: dict[int, int] = {}          # document: first token that bears loss
        self.tokens = 0

    def _loss(self, doc: int, start: int, end: int) -> int:
        return max(0, end - max(start, self.free_from.get(doc, 0)))

    def add(self, doc: int, n: int, prompt: int = 0) -> None:
        """A document of n tokens, of which the first ``prompt`` bear no loss."""
        if prompt:
            self.free_from[doc] = prompt
        start = 0
        while n - start >= self.length and self._loss(doc, start, start + self.length) <= self.loss:
            self.emit([(doc, start, start + self.length)])
            start += self.length
        while n > start:
            end = min(n, start + self.length, max(start, prompt) + self.loss)
            self.items.append((doc, start, end))
            self.tokens += end - start
            start = end

    def pack(self, last: bool = False) -> None:
        """Fill bins from the pool; before the last call the unfinished bin stays in it."""
        import numpy as np

        if not self.items:
            return
        limits = np.array([self.length, self.segments, self.loss], float)
        classes = Classes([((e - s, 1, self._loss(d, s, e)), (d, s, e)) for d, s, e in self.items])
        weights = classes.total / len(self.items) / limits  # a scarce resource counts more
        while classes.n:
            room, bin_ = limits.copy(), []
            while classes.n and (i := classes.best(weights * room / limits**2, room)) is not None:
                need, item = classes.take(i)
                bin_.append(item)
                room -= need
            if classes.n and room[0] >= 1 and room[1] >= 1:
                i = classes.best(weights * room / limits**2)
                _, (doc, start, end) = classes.take(i)
                cut = start + int(room[0])
                if cut < end and self._loss(doc, start, cut) <= room[2]:
                    bin_.append((doc, start, cut))
                    room[0], start = 0, cut
                classes.put((end - start, 1, self._loss(doc, start, end)), (doc, start, end))
            if not classes.n and room[0] >= 1:
                self.items = bin_ if not last else []
                self.tokens = sum(e - s for _, s, e in self.items)
                if last:
                    self._powers(bin_)
                return
            self._close(bin_, room[0])
        self.items, self.tokens = [], 0

    def _close(self, bin_, room) -> None:
        """A bin that is full of tokens, or that another limit has closed."""
        if room < 1:
            self.emit(bin_)
        else:
            self._powers(bin_)

    def _powers(self, bin_) -> None:
        """Sequences of 2^k tokens, largest first, whose sum is the bin."""
        left = sum(e - s for _, s, e in bin_)
        pieces, at = list(bin_), 0
        while left:
            size, out = 1 << (left.bit_length() - 1), []
            left -= size
            while size:
                doc, start, end = pieces[at]
                cut = min(end, start + size)
                out.append((doc, start, cut))
                size -= cut - start
                pieces[at] = (doc, cut, end)
                at += cut == end
            self.emit(out)


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, segments: int = SEGMENTS,
         loss: int | None = None, prompt: str | None = None) -> DataFrame:
    """One row per piece: document, place in it, sequence and place in that, CRC of its ids.

    ``prompt`` names a column with the number of leading tokens that bear no loss.
    """
    own = columns(docs, "doc_id", "text", *([prompt] if prompt else []))
    kind = own.schema["doc_id"].dataType.simpleString()

    def task(batches):
        import numpy as np
        import pyarrow as pa

        tokens, context = encoder(vocabulary, False), TaskContext.get()
        first = context.partitionId() << 32
        ids: dict[int, tuple] = {}
        rows: list[tuple] = []
        counts = [0, 0]  # documents, sequences

        def emit(pieces):
            offset = 0
            for doc, start, end in pieces:
                doc_id, values = ids[doc]
                loss_tokens = packer._loss(doc, start, end)
                rows.append((doc_id, start, end - start, zlib.crc32(values[start:end].astype("<u4").tobytes()),
                             len(values), first + counts[1], offset, loss_tokens))
                offset += end - start
            counts[1] += 1

        def out():
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, id_type if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows))], names)
            rows.clear()
            kept = {d for d, _, _ in packer.items}
            for d in [d for d in ids if d not in kept]:
                del ids[d]
                packer.free_from.pop(d, None)
            return batch

        packer, id_type = Packer(emit, length, segments, loss), pa.int64()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            prompts = batch.column(prompt).to_pylist() if prompt else [0] * batch.num_rows
            for doc_id, text, p in zip(batch.column("doc_id").to_pylist(), batch.column("text"), prompts):
                got = np.frombuffer(tokens.encode(text.as_py() or ""), "<u2")
                ids[counts[0]] = (doc_id, np.append(got, np.uint16(END)))
                packer.add(counts[0], len(got) + 1, p or 0)
                counts[0] += 1
                if packer.tokens >= POOL:
                    packer.pack()
            if len(rows) >= 4096:
                yield out()
        packer.pack(last=True)
        if rows:
            yield out()

    return own.mapInArrow(task, SCHEMA.format(kind))
