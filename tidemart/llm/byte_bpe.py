"""Byte-level BPE encoding by backtracking from longest matches, and decoding."""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pieces a task remembers twice over (those met lately and those before them), and token pairs it remembers; forgetting
# changes no result.
MEMORY = 100_000
REMEMBERED_CHARS = 64
# Start positions whose matches are held at once: bounds the memory of a piece of megabytes.
BLOCK = 4096
# A letter, a digit, a sign and white space: a character after the sample of its own class makes one piece with it.
CLASS_SAMPLES = ("a", "1", "!", "\n")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids from a file of base64 tokens with their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class MergeTable:
    """How BPE builds each token: ``split[t]`` are the two tokens that merge into ``t``, ``merge`` is its inverse.

    A token splits where its halves have lower ranks and BPE would leave them side by side under the merges of lower rank; such a
    cut is unique.  Every token of a trained vocabulary has one, and then a row of tokens is what BPE gives exactly when all its
    neighbours are ``compatible``.  A vocabulary with a token that merges of lower rank never build is refused.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.tokens = {rank: token for token, rank in ranks.items()}
        if len(self.tokens) != len(ranks):
            raise ValueError("ranks repeat")
        self.split = {rank: (rank, rank) for token, rank in ranks.items() if len(token) == 1}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, token in sorted(self.tokens.items()):
            if len(token) == 1:
                continue
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left in self.split and right in self.split and max(left, right) < rank and self.compatible(left, right):
                    self.split[rank] = (left, right)
                    self.merge[left, right] = rank
                    break
            else:
                raise ValueError(f"no merges of lower rank build token {rank}")

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens as they are when their bytes stand side by side.

        Undoes the merges inside both tokens from the last one back.  At each moment the two parts that touch must not have had a
        merge of their own that comes before the merge just undone (of equal ranks the left one came first).
        """
        split, merge = self.split, self.merge
        before = None
        while True:
            joint = merge.get((left, right))
            if joint is not None and (before is None or joint < before):
                return False
            inner_left, inner_right = split[left], split[right]
            whole_left, whole_right = inner_left[1] == left, inner_right[0] == right
            if whole_left and whole_right:
                return True
            if not whole_left and (whole_right or left > right):
                before, left = left, inner_left[1]
            else:
                before, right = right + 1, inner_right[0]


def class_stand_ins(pattern: str) -> dict[int, str]:
    """Code points that ``regex`` and tiktoken put into different classes, each with a stand-in of tiktoken's class.

    The two libraries know different versions of Unicode.  tiktoken looks a whole piece up before merging, so a vocabulary that
    holds a string shows whether tiktoken sees one piece: runs of one class are asked in blocks, blocks that differ one by one.
    """
    import regex
    import tiktoken

    split = regex.compile(pattern).findall
    singles = {bytes([b]): b for b in range(256)}

    def one_piece(strings: list[str]) -> list[bool]:
        ranks = dict(singles)
        for s in strings:
            ranks.setdefault(s.encode(), len(ranks))
        encode = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return [len(encode(s)) == 1 for s in strings]

    def own_class(chars: str) -> str | None:
        return next((k for k in CLASS_SAMPLES if len(split(k + chars)) == 1), None)

    members: dict[str, list[str]] = {}
    for start in range(0x80, 0x110000, 128):
        chars = [chr(c) for c in range(start, start + 128) if not 0xD800 <= c <= 0xDFFF]
        shared = own_class("".join(chars)) if chars else None
        for c in chars:
            members.setdefault(shared or own_class(c), []).append(c)
    blocks = [(k, chars[i:i + 256]) for k, chars in members.items() for i in range(0, len(chars), 256)]
    agree = one_piece([k + "".join(chars) for k, chars in blocks])
    doubtful = [(k, c) for (k, chars), same in zip(blocks, agree) if not same for c in chars]
    found: dict[str, str] = {}
    for k in CLASS_SAMPLES:
        found |= {c: k for (_, c), same in zip(doubtful, one_piece([k + c for _, c in doubtful])) if same}
    return {ord(c): found[c] for k, c in doubtful if c in found and found[c] != k}


class Encoder:
    """Token ids of texts: longest matches first, a step back where two neighbours are not what BPE would leave."""

    def __init__(self, ranks: dict[bytes, int], table: MergeTable, pattern: str, stand_ins: dict[int, str]) -> None:
        import ahocorasick
        import regex

        self.ranks, self.table = ranks, table
        self.pieces = regex.compile(pattern)
        self.stand_ins = stand_ins
        self.odd = frozenset(map(chr, stand_ins))
        self.automaton = ahocorasick.Automaton()
        self.length = {}
        for rank, token in table.tokens.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
            self.length[rank] = len(token)
        self.automaton.make_automaton()
        self.longest = max(self.length.values())
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        fits = self.pairs.get((left, right))
        if fits is None:
            if len(self.pairs) >= MEMORY:
                self.pairs.clear()
            fits = self.pairs[left, right] = self.table.compatible(left, right)
        return fits

    def matches(self, text: str, first: int = 0) -> list[list[int]]:
        """For each of the ``BLOCK`` positions from ``first`` on the tokens that begin there, the shortest first."""
        size, length = min(BLOCK, len(text) - first), self.length
        # A match that ends in the block's tail may begin past it; those lists are dropped.
        found: list[list[int]] = [[] for _ in range(min(size + self.longest, len(text) - first))]
        for end, token in self.automaton.iter(text, first, first + len(found)):
            found[end + 1 - first - length[token]].append(token)
        # Tokens that end earlier are found earlier, so each list is in order of length.
        return found[:size]

    def merged(self, data: bytes) -> array:
        """Ids of one piece.  Only one row of tokens that BPE leaves reaches a position, so each is given up at most once."""
        if (whole := self.ranks.get(data)) is not None:
            return array("I", [whole])
        text, n = data.decode("latin-1"), len(data)
        length, pairs, compatible = self.length, self.pairs, self.compatible
        blocks: dict[int, list[list[int]]] = {}

        def in_blocks(position: int) -> list[int]:
            block, place = divmod(position, BLOCK)
            if block not in blocks:
                if len(blocks) > 3:
                    blocks.clear()
                blocks[block] = self.matches(text, block * BLOCK)
            return blocks[block][place]

        at = self.matches(text).__getitem__ if n <= BLOCK else in_blocks
        # Tokens so far, and how many shorter ones were left to try in the place of each.
        ids: list[int] = []
        untried: list[int] = []
        given_up: set[int] = set()
        position, last = 0, None
        choices = at(0)
        left = len(choices)
        while True:
            while left:
                left -= 1
                token = choices[left]
                end = position + length[token]
                if end in given_up:
                    continue
                if last is not None:
                    fits = pairs.get((last, token))
                    if not (compatible(last, token) if fits is None else fits):
                        continue
                ids.append(token)
                if end == n:
                    return array("I", ids)
                untried.append(left)
                position, last = end, token
                choices = at(position)
                left = len(choices)
                break
            else:
                # Nothing fits here: the token before gives way to a shorter one.
                given_up.add(position)
                position -= length[ids.pop()]
                left = untried.pop()
                choices = at(position)
                last = ids[-1] if ids else None

    def split(self, text: str) -> list[str]:
        if text.isascii() or self.odd.isdisjoint(text):
            return self.pieces.findall(text)
        return [text[m.start():m.end()] for m in self.pieces.finditer(text.translate(self.stand_ins))]

    def packed(self, piece: str) -> bytes:
        ids = self.merged(piece.encode("utf-8"))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.older.get(piece) or self.packed(piece)
                if len(piece) <= REMEMBERED_CHARS:
                    if len(known) >= MEMORY:
                        # Pieces that are still in use come back from the older ones.
                        self.older, self.known = known, {}
                        known = self.known
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit token ids of the whole text).

    Each match of ``pattern`` is encoded by itself, without special tokens.  Rows stay where they are read: one narrow pass, whose
    tasks hold the vocabulary, a bounded memory of pieces and pairs, and the text at hand.  Null and empty texts have no ids;
    repeated rows repeat; other columns do not matter.
    """
    MergeTable(read_ranks(ranks_path))  # refuses a vocabulary here, not in every task
    stand_ins = class_stand_ins(pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        encoder = Encoder(ranks, MergeTable(ranks), pattern, stand_ins)
        for batch in batches:
            ids = [encoder.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                                              pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(encode, "doc_id long, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with ``data``, the bytes its ids stand for; null ids stand for none.

    An id that the vocabulary lacks raises, like a file cut inside an id.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in read_ranks(ranks_path).items()}
        for batch in batches:
            data = [b"".join(map(tokens.__getitem__, memoryview(ids or b"").cast("I"))) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())],
                                             names=["doc_id", "n_tokens", "ids", "data"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(decode, "doc_id long, n_tokens long, ids binary, data binary")
