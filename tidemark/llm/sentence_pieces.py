"""Operator 2. SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

The model is a BPE model (parameter: the model file's bytes; nothing is
trained). A best-score path over its pieces is not what BPE merging yields, so
the forward pass maximises over admissible paths instead: a segmentation is the
BPE result if and only if every two neighbouring pieces, merged on their own,
come out as just these two pieces. (No merge can cross a boundary that it would
not cross in the pair alone, as the best-ranked merge of the whole is also the
best-ranked of the pair.) Hence each prefix of a word has exactly one admissible
last piece, and the forward state of a prefix depends on the prefix alone.

Texts are marked as the model says (a leading mark, spaces as marks) and cut
into words where no merge can reach across: before marks, and between signs and
other characters that are neighbours in no piece. The distinct new words of a batch
are sorted, which is a depth-first walk over their trie: a word keeps the
forward states of the prefix that it shares with the word before and only
extends the rest. Results equal the sentencepiece library's, id for id.

Words already segmented and piece pairs already judged are kept per worker, up
to MEMO_WORDS and MEMO_PAIRS entries; then the memo starts anew (results do not
depend on it). Whole texts are read. Edge cases: a null or empty text has no
ids; characters without a piece become byte pieces; a literal mark character is
kept as a mark and decodes to a space (so such a text does not round-trip, as
in the library); null or repeated ids of documents are passed through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, released, slices, text_buffer

MARK = "▁"
MEMO_WORDS, MEMO_PAIRS = 200_000, 200_000
#: Bytes of text that are encoded at a time (the temporaries are some ten times larger).
SLICE_BYTES = 2 << 20


def model_bytes(path: str | None = None) -> bytes:
    """The model file (by default the public 32k piece model); read on the driver, some 0.5 MB."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


class Pieces:
    """Vocabulary of a BPE model and the forward pass over it."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(size)]
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in range(size) if not special[i]}
        ids = {sp.id_to_piece(i): i for i in range(size)}
        self.ids = {p: ids[p] for p in self.rank}
        self.byte_ids = [ids[f"<0x{b:02X}>"] for b in range(256)]
        # decoding: control pieces are silent, the unknown piece as the library shows it
        self.raw = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i)
                    else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                    else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        # neighbours inside some piece: between any other two characters no merge can reach
        near: dict[str, set[str]] = {}
        for p in self.rank:
            for a, b in zip(p, p[1:]):
                if b == MARK != a:
                    raise ValueError("a piece reaches across a mark: runs cannot be cut at spaces")
                if a != MARK:
                    near.setdefault(a, set()).add(b)
                    near.setdefault(b, set()).add(a)
        # marks and signs that are neighbours of such signs only; anything else is cut from them
        signs = {c for c in near if not c.isalpha()}
        while lost := {c for c in signs if not near[c] <= signs}:
            signs -= lost
        cls = "".join(map(re.escape, sorted(signs | {"\n"} - near.keys())))
        self.word = re.compile(f"{MARK}*[^{cls}{MARK}]+|{MARK}*[{cls}]+|{MARK}+")
        # pieces by number (characters without a piece get one when first seen), their ids as bytes
        self.number = {p: n for n, p in enumerate(self.rank)}
        self.name = list(self.rank)
        self.coded = [np.array([self.ids[p]], "<i4").tobytes() for p in self.name]
        # lengths of the pieces that end in given characters (three, or two for shorter prefixes), longest first
        ends: dict[str, set[int]] = {}
        for p in self.name:
            if len(p) > 1:
                ends.setdefault(p[-2:], set()).add(len(p))
            if len(p) > 2:
                ends.setdefault(p[-3:], {1}).add(len(p))
        for k in [k for k in ends if len(k) == 3 and 2 in ends.get(k[1:], ())]:
            ends[k].add(2)
        self.lengths = {k: tuple(sorted(v | {1}, reverse=True)) for k, v in ends.items()}
        self.short = {k: (2, 1) for k, v in ends.items() if len(k) == 2 and 2 in v}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        """The words of a marked text: signs are cut from what no piece joins them to."""
        return self.word.findall(text)

    def merge(self, text: str) -> list[str]:
        """BPE by its definition (best-ranked merge first, leftmost of equals): the judge of short strings."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def character(self, c: str) -> int:
        """Number of a single character, which becomes byte pieces if it has no piece."""
        n = self.number.get(c)
        if n is None:
            n = self.number[c] = len(self.name)
            self.name.append(c)
            self.coded.append(np.array([self.byte_ids[b] for b in c.encode()], "<i4").tobytes())
        return n

    def admissible(self, key: int) -> bool:
        """Whether two neighbours (numbers ``before << 32 | piece``; before is -1 at the start of a word)
        stay as they are when merged on their own."""
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        before, piece = key >> 32, self.name[key & 0xFFFFFFFF]
        whole = [piece] if before < 0 else [self.name[before], piece]
        ok = self.pairs[key] = self.merge("".join(whole)) == whole
        return ok

    def extend(self, word: str, state: list[int]) -> None:
        """Forward pass: ``state[i]`` is the last piece of the first i characters; extends it to the whole word."""
        lengths, number, pairs = self.lengths, self.number, self.pairs
        short = self.short
        for end in range(len(state), len(word) + 1):
            if end > 2:
                sizes = lengths.get(word[end - 3:end]) or short.get(word[end - 2:end], (1,))
            else:
                sizes = short.get(word[:end], (1,))
            for size in sizes:
                if size > end:
                    continue
                n = number.get(word[end - size:end])
                if n is None:
                    if size > 1:
                        continue
                    n = self.character(word[end - 1])
                key = state[end - size] << 32 | n
                ok = pairs.get(key)
                if ok or ok is None and self.admissible(key):
                    state.append(n)
                    break
            else:
                raise AssertionError(f"no admissible piece ends at {end} of {word!r}")

    def learn(self, words: set[str]) -> None:
        """Segment the distinct ``words``: sorted, they are a depth-first walk over their trie."""
        last, state, name, coded = "", [-1], self.name, self.coded
        for word in sorted(words):
            shared, most = 0, min(len(last), len(word))
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del state[shared + 1:]
            self.extend(word, state)
            out, end = [], len(word)
            while end:
                n = state[end]
                out.append(coded[n])
                end -= len(name[n])
            out.reverse()
            self.words[word] = b"".join(out)
            last = word

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        return self.joined([self.cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts])

    def joined(self, cut: list[list[str]]) -> list[bytes]:
        """The ids of texts that are given as words."""
        new = set().union(*cut).difference(self.words)
        if new:
            if len(self.words) + len(new) > MEMO_WORDS:
                self.words.clear()
                new = set().union(*cut)
            self.learn(new)
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in cut]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each); null is the empty text.

        Arrow cuts at spaces and numbers the runs, so Python sees the batch's
        distinct runs only. Texts in which spaces meet, lead, end or stand with
        literal marks (a mark then belongs to more than one run) are cut whole."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, f"^ |  | $|{MARK}|^$").to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd))
        runs = pc.split_pattern(plain, " ")
        numbered = runs.flatten().dictionary_encode()
        found = []
        if len(numbered.dictionary):  # one Python string, cut again at spaces: runs hold none
            all_runs = pa.ListArray.from_arrays(pa.array([0, len(numbered.dictionary)], pa.int32()), numbered.dictionary)
            found = self.joined([self.cut(MARK + r) for r in pc.binary_join(all_runs, " ")[0].as_py().split(" ")])
        whole = self.encode(texts.filter(pa.array(odd)).to_pylist())
        # the pool: distinct runs, then whole texts; every text is a list of pool entries
        pool = np.frombuffer(b"".join(found + whole), "<i4")
        size = np.fromiter(map(len, found + whole), np.int64, len(found) + len(whole)) // 4
        entries = np.ones(len(texts), np.int64)
        entries[~odd] = np.diff(runs.offsets.to_numpy())
        of = np.empty(int(entries.sum()), np.int64)
        in_odd = np.repeat(odd, entries)
        of[~in_odd] = numbered.indices.to_numpy()
        of[in_odd] = len(found) + np.arange(len(whole))
        n = size[of]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(size) - size)[of] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return pool[at], np.diff(np.append(0, np.append(0, ends)[np.cumsum(entries)]))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


_LOADED: dict[int, Pieces] = {}


def pieces(model: bytes) -> Pieces:
    """One instance per worker and model, so the memo lasts from batch to batch."""
    key = hash(model)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


def encode(docs: DataFrame, model: bytes | None = None, check: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids and (``check``) round_trip: whether the ids decode to the text; long columns to ``carry`` come last."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model or model_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(shared.value)
        for b in (b.slice(lo, hi - lo) for b in batches for lo, hi in slices(text_buffer(b.column("text"))[1], SLICE_BYTES)):
            ids, n = p.encode_batch(b.column("text"))
            ends = np.append(0, np.cumsum(n))
            columns = {"doc_id": b.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                       "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))}
            if check:
                columns["round_trip"] = pa.array([p.decode(ids[a:z].tolist()) == (t or "") for a, z, t in zip(
                    ends, ends[1:], b.column("text").to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_pydict(columns | {c: b.column(c) for c in carry})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    return narrow.mapInArrow(released(run), "doc_id long, n_tokens long, ids array<int>" + ", round_trip boolean" * check
                             + "".join(f", {c} long" for c in carry))


def decode(encoded: DataFrame, model: bytes | None = None) -> DataFrame:
    """doc_id and text of a table with doc_id and ids (null ids: an empty text; ids out of range are an error)."""
    spark: SparkSession = encoded.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model or model_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([p.decode(x or []) for x in b.column("ids").to_pylist()], pa.string())],
                names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")
                          ).mapInArrow(run, "doc_id long, text string")
