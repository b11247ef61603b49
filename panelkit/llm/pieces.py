"""A unigram piece vocabulary, its Aho-Corasick automaton and single-pass Viterbi.

The vocabulary is read from a SentencePiece model file: pieces, scores, the
byte pieces and the unknown piece. The pieces go into a byte trie with failure
links; ``goto`` is complete, so a text is read once, a table look-up per byte.
From the state after each byte the output links lead through all pieces that
end there, longest first, and relax the best score at that position.

Ties follow the tokenizer: a later candidate has to be strictly better, so of
equal scores the longest last piece wins. A character that is no piece itself
may be taken as unknown, at the smallest score less 10, after the pieces that
end with it; with byte pieces it counts as its UTF-8 bytes.

Scores add up in double precision (exact for the file's whole-number scores).

Units. No piece holds the word mark after another character, so every
segmentation has a boundary before each run of spaces, and around any byte that
occurs in no longer piece (such as a line break). Texts are cut into such units
and each distinct unit of a slice is segmented once; the automaton walks many
units side by side. Units are told apart by a 64-bit hash and then by their
bytes. A vocabulary that breaks the rule for spaces is refused.

Spaces stand for the word mark: ``\\u2581`` in pieces is kept as a space, and one
space is put before a text that isn't empty. A ``\\u2581`` in the text itself has
no piece then and is written in bytes, so decoding is exact.
"""

from __future__ import annotations

import numpy as np

from panelkit.llm.text import span_hashes, worker_cache

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Units up to this length are walked side by side, ``LANES`` at a time.
LANE_BYTES, LANES = 48, 1 << 15


class Vocabulary:
    """Pieces as byte strings with scores and ids; ``bytes_`` are the ids of the 256 byte pieces, or None."""

    def __init__(self, pieces, scores, ids, bytes_, unknown):
        self.pieces, self.scores, self.ids = pieces, scores, ids
        self.bytes_, self.unknown = bytes_, unknown
        if any(b" " in p.lstrip(b" ") for p in pieces):
            raise ValueError("a piece holds the word mark after another character")

    @staticmethod
    def load(path: str | None = None, proto: bytes | None = None) -> Vocabulary:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path) if path else \
            sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        fixed = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        ids = [i for i in range(n) if not fixed[i]]
        bytes_ = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        return Vocabulary([sp.id_to_piece(i).replace(MARK, " ").encode() for i in ids],
                          [sp.get_score(i) for i in ids], ids,
                          [bytes_[b] for b in range(256)] if len(bytes_) == 256 else None, sp.unk_id())


class Automaton:
    def __init__(self, vocab: Vocabulary):
        self.unknown_score = min(vocab.scores) - UNKNOWN_PENALTY
        self.byte_ids = None if vocab.bytes_ is None else np.array(vocab.bytes_, np.int32)
        self.unknown = vocab.unknown
        used = sorted({b for p in vocab.pieces for b in p})
        self.cls = np.zeros(256, np.int32)  # class 0: bytes of no piece
        self.cls[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        longer = {b for p in vocab.pieces if len(p.decode()) > 1 for b in p}
        self.isolated = np.zeros(256, bool)
        self.isolated[[b for b in range(128) if b not in longer and b != 0x20]] = True
        self._build(vocab)

    def _build(self, vocab):
        children = [{}]
        node_of, depth = [], [0]
        for p in vocab.pieces:
            at = 0
            for b in p:
                c = int(self.cls[b])
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    depth.append(depth[at] + 1)
                at = children[at][c]
            node_of.append(at)
        n = len(children)
        self.length, self.score, self.id = np.zeros(n, np.int32), np.zeros(n), np.full(n, -1, np.int32)
        own = np.zeros(n, bool)
        for at, p, s, i in zip(node_of, vocab.pieces, vocab.scores, vocab.ids):
            self.length[at], self.score[at], self.id[at], own[at] = len(p), s, i, True
        goto = np.zeros((n, self.width), np.int32)
        fail, out, link = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
        level = [0]
        while level:
            below = []
            for at in level:
                f = fail[at]
                if at:
                    goto[at] = goto[f]
                    # the longest piece that ends here, and the next one after it
                    link[at] = out[f]
                    out[at] = at if own[at] else out[f]
                for c, to in children[at].items():
                    fail[to] = goto[f, c] if at else 0
                    goto[at, c] = to
                    below.append(to)
            level = below
        self.goto, self.out, self.link = goto.ravel(), out, link

    # -- units ---------------------------------------------------------------

    def units(self, data: np.ndarray, offsets: np.ndarray):
        """The marked bytes, and where units start; texts that aren't empty get a space in front."""
        size = np.diff(offsets)
        some = size > 0
        moved = offsets + np.concatenate([[0], np.cumsum(some)])
        marked = np.empty(int(moved[-1]), np.uint8)
        front = moved[:-1][some]
        text = np.ones(len(marked), bool)
        text[front] = False
        marked[front] = 0x20
        marked[text] = data
        space, alone = marked == 0x20, self.isolated[marked]
        first = alone.copy()
        first[1:] |= alone[:-1]
        first[1:] |= space[1:] & ~space[:-1]
        first[front] = True
        starts = np.flatnonzero(first)
        return marked, starts, np.append(starts[1:], len(marked)), np.searchsorted(starts, moved)

    def distinct(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Indices of distinct units and, for each unit, its place among them."""
        hashes = span_hashes(data, starts, ends)
        _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        size = ends - starts
        same = size == size[index][inverse]
        if not same.all():  # two units with one hash: keep every unit apart
            return np.arange(len(starts)), np.arange(len(starts))
        return index, inverse

    # -- Viterbi -------------------------------------------------------------

    def walk(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, trace: bool):
        """Best segmentation of each unit. Yields (unit indices, counts, back):
        ``back[lane, j]`` is the last piece's node of the best path to byte j
        (or minus the bytes of an unknown character), only with ``trace``."""
        order = np.argsort(-sizes, kind="stable")
        n_long = int(np.searchsorted(-sizes[order], -LANE_BYTES, side="left"))
        for k in order[:n_long]:
            yield self._one(data[starts[k]:starts[k] + sizes[k]], k, trace)
        for at in range(n_long, len(order), LANES):
            block = order[at:at + LANES]
            yield self._lanes(data, starts[block], sizes[block], block, trace)

    def _lanes(self, data, starts, sizes, block, trace):
        n, top = len(block), int(sizes[0])
        w = top + 1
        best, count = np.full(n * w, -np.inf), np.zeros(n * w, np.int32)
        back = np.zeros(n * w, np.int32) if trace else None
        row = np.arange(n) * w
        best[row] = 0.0
        state, char = np.zeros(n, np.int64), np.zeros(n, np.int64)
        padded = np.append(data, np.uint8(0x20))
        left = np.searchsorted(-sizes, -np.arange(1, top + 1), side="right")
        for j in range(top):
            a = int(left[j])  # lanes that have a byte j
            byte = padded[starts[:a] + j]
            state[:a] = self.goto[state[:a] * self.width + self.cls[byte]]
            new = (byte & 0xC0) != 0x80
            char[:a][new] = j
            long_ = j + 1 - char[:a]
            single = np.zeros(a, bool)
            lane, node = np.arange(a), self.out[state[:a]]
            while True:
                on = node > 0
                if not on.all():
                    lane, node = lane[on], node[on]
                if not len(lane):
                    break
                length = self.length[node]
                src, dst = row[lane] + j + 1 - length, row[lane] + j + 1
                value = best[src] + self.score[node]
                single[lane[length == long_[lane]]] = True
                up = value > best[dst]
                d, s = dst[up], src[up]
                best[d] = value[up]
                count[d] = count[s] + 1
                if trace:
                    back[d] = node[up]
                node = self.link[node]
            last = (starts[:a] + j + 1 == starts[:a] + sizes[:a]) | ((padded[starts[:a] + j + 1] & 0xC0) != 0x80)
            lane = np.flatnonzero(last & ~single)
            if len(lane):
                src, dst = row[lane] + char[lane], row[lane] + j + 1
                value = best[src] + self.unknown_score
                up = value > best[dst]
                d, s, k = dst[up], src[up], long_[lane][up]
                best[d] = value[up]
                count[d] = count[s] + (k if self.byte_ids is not None else 1)
                if trace:
                    back[d] = -k
        ends = row + sizes
        return block, count[ends], back.reshape(n, w) if trace else None

    def _one(self, text, k, trace):
        """One long unit, byte by byte; the arrays are as long as the unit."""
        n = len(text)
        best, count, back = [0.0] + [-np.inf] * n, [0] * (n + 1), [0] * (n + 1)
        state, char = 0, 0
        raw, cls = text.tobytes(), self.cls.tolist()
        goto, out, link, length, score = self.goto, self.out, self.link, self.length, self.score
        per_byte = self.byte_ids is not None
        for j, b in enumerate(raw):
            state = int(goto[state * self.width + cls[b]])
            if b & 0xC0 != 0x80:
                char = j
            single, node, here = False, int(out[state]), -np.inf
            while node:
                m = int(length[node])
                value = best[j + 1 - m] + score[node]
                single |= m == j + 1 - char
                if value > here:
                    here, count[j + 1], back[j + 1] = value, count[j + 1 - m] + 1, node
                node = int(link[node])
            if not single and (j + 1 == n or raw[j + 1] & 0xC0 != 0x80):
                value = best[char] + self.unknown_score
                if value > here:
                    here, back[j + 1] = value, char - j - 1
                    count[j + 1] = count[char] + (j + 1 - char if per_byte else 1)
            best[j + 1] = here
        return np.array([k]), np.array([count[n]], np.int32), np.array([back], np.int32) if trace else None

    # -- what the operators ask for --------------------------------------------

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Pieces of each text."""
        marked, starts, ends, first = self.units(data, offsets)
        index, inverse = self.distinct(marked, starts, ends)
        out = np.zeros(len(index), np.int64)
        for lanes, n, _ in self.walk(marked, starts[index], (ends - starts)[index], False):
            out[lanes] = n
        total = np.concatenate([[0], np.cumsum(out[inverse])])
        return np.diff(total[first])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the pieces of each text."""
        marked, starts, ends, first = self.units(data, offsets)
        index, inverse = self.distinct(marked, starts, ends)
        sizes, starts = (ends - starts)[index], starts[index]
        found = list(self.walk(marked, starts, sizes, True))
        n = np.zeros(len(index), np.int64)
        for lanes, c, _ in found:
            n[lanes] = c
        at = np.concatenate([[0], np.cumsum(n)])
        ids = np.empty(int(at[-1]), np.int32)
        for lanes, _, back in found:
            self._read_back(marked, starts[lanes], sizes[lanes].copy(), at[lanes + 1].copy(), back, ids)
        each = n[inverse]
        upto = np.concatenate([[0], np.cumsum(each)])
        take = np.repeat(at[:-1][inverse] - upto[:-1], each) + np.arange(upto[-1])
        return upto[first], ids[take]

    def _read_back(self, data, starts, pos, to, back, ids):
        """Follow the last pieces from the end of each unit; ids are filled backwards."""
        lane = np.arange(len(starts))
        while True:
            lane = lane[pos[lane] > 0]
            if not len(lane):
                return
            node = back[lane, pos[lane]]
            known = node > 0
            a = lane[known]
            to[a] -= 1
            ids[to[a]] = self.id[node[known]]
            pos[a] -= self.length[node[known]]
            b, k = lane[~known], -node[~known]
            if self.byte_ids is None:
                to[b] -= 1
                ids[to[b]] = self.unknown
            else:
                for m in range(1, 5):
                    own = b[k >= m]
                    ids[to[own] - m] = self.byte_ids[data[starts[own] + pos[own] - m]]
                to[b] -= k
            pos[b] -= k


def automaton(vocab: Vocabulary, key: str) -> Automaton:
    """The automaton of a vocabulary, built once in a Python worker."""
    kept = worker_cache()
    if key not in kept:
        kept[key] = Automaton(vocab)
    return kept[key]


class Decoder:
    """Ids back to text."""

    def __init__(self, vocab: Vocabulary):
        size = max([*vocab.ids, *(vocab.bytes_ or []), vocab.unknown]) + 1
        table = [b""] * size
        for p, i in zip(vocab.pieces, vocab.ids):
            table[i] = p
        for b, i in enumerate(vocab.bytes_ or []):
            table[i] = bytes([b])
        table[vocab.unknown] = " ⁇ ".encode()
        self.size = np.array([len(x) for x in table], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.data = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, UTF-8 bytes) of the texts; the space in front is taken off. Ids of control pieces give nothing."""
        ids = np.where((ids >= 0) & (ids < len(self.size)), ids, 0)
        each = self.size[ids]
        upto = np.concatenate([[0], np.cumsum(each)])
        out = self.data[np.repeat(self.at[ids] - upto[:-1], each) + np.arange(upto[-1])]
        edge = upto[offsets]
        some = edge[:-1] < edge[1:]
        front = edge[:-1][some]
        front = front[out[front] == 0x20]
        keep = np.ones(len(out), bool)
        keep[front] = False
        shift = np.concatenate([[0], np.cumsum(~keep)])
        return edge - shift[edge], out[keep]
