"""Removal of repeated word windows with prefix-partitioned suffix trees.

The suffixes that start at candidate windows (see ``windows``) are split by their leading words:
one word first, and more words where a prefix holds more suffixes than fit in memory, so every
group is of bounded size.  Each group becomes a subtree, grown top down: a node's suffixes are
split by the words that follow, nodes of one suffix are leaves and grow no further.  Nodes that
are still internal at the depth of the window are the repeats; the suffixes below them, and leaves
of contents that occur several times, start repeated windows.  Words are compared by 64-bit hash.

Defined cases: null and wordless texts have no words; texts shorter than the window lose nothing;
equal texts at least that long lose every word; windows never cross texts; repeated rows are
separate texts; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import windows
from tidemark.llm.common import buffer_of
from tidemark.llm.windows import Spec, Symbols

WINDOW = 35
GRAM = 6
#: Suffixes in one subtree.
GROUP = 1 << 16
#: Words on an edge between two levels of nodes.
EDGE = 5


def prefix_groups(ids: np.ndarray, place: np.ndarray, width: int, most: int):
    """Groups of suffixes, none larger than ``most`` unless its windows are equal throughout.

    Yields members (indices of ``place``) and whether they agree over the whole window.
    """
    waiting = [(np.arange(len(place)), 0)]
    while waiting:
        members, depth = waiting.pop()
        if len(members) <= most or depth == width:
            yield members, depth == width
            continue
        word = ids[place[members] + depth]
        order = np.argsort(word, kind="stable")
        members, word = members[order], word[order]
        ends = np.append(np.flatnonzero(word[1:] != word[:-1]) + 1, len(members))
        begin, last = 0, 0
        for end in ends.tolist():
            # Small prefixes share a group; a large one goes on alone with one more word.
            if end - last > most:
                if last > begin:
                    yield members[begin:last], False
                waiting.append((members[last:end], depth + 1))
                begin = end
            elif end - begin > most:
                yield members[begin:last], False
                begin = last
            last = end
        if last > begin:
            yield members[begin:last], False


def grow(edge: np.ndarray, place: np.ndarray, weight: np.ndarray, width: int, step: int) -> np.ndarray:
    """Flags of the suffixes below an internal node at depth ``width`` of their subtree."""
    again = weight > 1
    open_ = np.arange(len(place))
    node = np.zeros(len(place), np.int64)
    depth = 0
    while depth < width and len(open_):
        words = edge[place[open_] + min(depth, width - step)]
        order = np.lexsort((words, node))
        open_, node, words = open_[order], node[order], words[order]
        new = np.r_[True, (node[1:] != node[:-1]) | (words[1:] != words[:-1])]
        node = np.cumsum(new) - 1
        inner = np.bincount(node)[node] > 1
        open_, node = open_[inner], node[inner]
        depth += step
    again[open_] = True
    return again


def repeated_starts(spec: Spec, sym: Symbols, weights: np.ndarray, most: int = GROUP) -> np.ndarray:
    """Flag per word: a window starts here whose words occur again among the weighted segments."""
    again = np.zeros(len(sym.ids), bool)
    starts = np.maximum(np.diff(sym.at) - spec.width + 1, 0)
    total = int(starts.sum())
    if not total:
        return again
    place = np.repeat(sym.at[:-1], starts) + np.arange(total) - np.repeat(np.cumsum(starts) - starts, starts)
    weight = np.repeat(weights, starts)
    step = min(EDGE, spec.width)
    edge = windows.gram_hash(sym.ids, step)
    for members, equal in prefix_groups(sym.ids, place, spec.width, most):
        at = place[members]
        again[at] = len(members) > 1 if equal else grow(edge, at, weight[members], spec.width, step)
        if equal:
            again[at] |= weight[members] > 1
    return again


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
          shard: int = windows.SHARD, hot: int = windows.HOT) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of every row; ``kept`` joins the kept words by a space."""
    spec = Spec(words=True, width=window, gram=gram)
    rows = windows.keyed(docs, id_col, text_col)
    marked = windows.with_spans(rows, windows.repeated(spec, rows, repeated_starts, shard, hot))

    def run(batches):
        for batch in batches:
            raw, at = buffer_of(batch.column(1))
            spans, count, removed, kept = batch.column(2), [], [], []
            for i in range(batch.num_rows):
                words = raw[at[i]:at[i + 1]].tobytes().split()
                if spans[i].is_valid:
                    gone = windows.covered(len(words), spans[i].as_py())
                    stay = [words[k] for k in np.flatnonzero(~gone)]
                else:
                    stay = words
                count.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return marked.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string")
