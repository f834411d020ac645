"""SentencePiece encoding and decoding by a forward pass over a trie of distinct marked words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2

from pathgauge.llm.common import chunks, list_array

MARK = "▁"
#: Words whose pieces a worker remembers in each of two generations; words that come up again move to the newer one.
REMEMBERED = 150_000
#: Neighbouring pieces a worker remembers, in each of two generations likewise; a pair holds about 250 bytes.
PAIRS = 200_000
#: Longer words (runs without a space) are worked out anew each time, so that what is remembered stays small.
LONGEST = 256

_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
_UNIGRAM, _BPE = 1, 2
_NEVER = float("-inf")


def default_model() -> str:
    """Place of the installed public vocabulary; pass another path to use another one."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    ids: dict[str, int]
    scores: dict[str, float]
    #: Bytes that each id stands for.
    spelled: list[bytes]
    byte_ids: list[int]
    unknown: int
    is_bpe: bool
    dummy_prefix: bool
    #: The last join that makes each piece of a BPE vocabulary; pieces that no joins lead to are left out.
    joins: dict[str, tuple[str, str]]


def load(path: str) -> Vocabulary:
    """Pieces and scores of a model file of type BPE or UNIGRAM that leaves characters as they are."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules = model.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("this model rewrites characters or white space, which is not supported")
    if model.trainer_spec.model_type not in (_UNIGRAM, _BPE):
        raise ValueError("only models of type BPE and UNIGRAM are supported")
    ids, scores, spelled = {}, {}, []
    byte_ids, unknown = [-1] * 256, 0
    for k, piece in enumerate(model.pieces):
        spelling = b""
        if piece.type in (_NORMAL, _USER):
            ids[piece.piece], scores[piece.piece] = k, piece.score
            spelling = piece.piece.replace(MARK, " ").encode()
        elif piece.type == _BYTE:
            byte_ids[int(piece.piece[1:-1], 16)] = k
            spelling = bytes([int(piece.piece[1:-1], 16)])
        elif piece.type == _UNKNOWN:
            unknown, spelling = k, " ⁇ ".encode()
        spelled.append(spelling)
    if any(MARK in p.lstrip(MARK) for p in ids) or any("\n" in p and len(p) > 1 for p in ids):
        raise ValueError("pieces that go on over a space or a line feed are not supported")
    is_bpe = model.trainer_spec.model_type == _BPE
    joins: dict[str, tuple[str, str]] = {}
    for piece in ids if is_bpe else ():
        done: list[tuple[str, str]] = []
        if len(piece) > 1 and merged(list(piece), scores, done) == [piece]:
            joins[piece] = done[-1]
    return Vocabulary(
        ids, scores, spelled, byte_ids if min(byte_ids) >= 0 else [], unknown, is_bpe, rules.add_dummy_prefix, joins
    )


def merged(symbols: list[str], scores: dict[str, float], done: list[tuple[str, str]] | None = None) -> list[str]:
    """The BPE rule itself: join the neighbours of the best score, the leftmost of equals, until none is left."""
    symbols = list(symbols)
    while len(symbols) > 1:
        best, at = None, -1
        for i, (a, b) in enumerate(zip(symbols, symbols[1:])):
            score = scores.get(a + b)
            if score is not None and (best is None or score > best):
                best, at = score, i
        if at < 0:
            break
        if done is not None:
            done.append((symbols[at], symbols[at + 1]))
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


@dataclass
class Encoder:
    """Encodes marked words; keeps what neighbouring words in sorted order share.

    The forward pass gives every prefix of a word its last piece and score. The
    distinct words are sorted, which lays them out as a depth-first walk through
    their trie: the states of a common prefix stay on the stack and only the
    rest of the next word is worked out.

    UNIGRAM vocabulary: the best total score wins (Viterbi). BPE vocabulary: a
    step from one piece to the next is open only if BPE leaves the two pieces
    standing side by side. As a prefix of a BPE segmentation is the segmentation
    of its prefix, one open path reaches each position and gives BPE's result.
    """

    vocabulary: Vocabulary
    pairs: dict[tuple[str, str], bool] = field(default_factory=dict)
    older_pairs: dict[tuple[str, str], bool] = field(default_factory=dict)
    borders: dict[tuple[str, int], list[str]] = field(default_factory=dict)
    #: Ids of words, as the bytes of 32-bit integers.
    known: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)
    tails: set[str] = field(default_factory=set)
    piece_ids: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.tails = {p[k:] for p in self.vocabulary.scores for k in range(len(p))}
        self.piece_ids = {p: _packed([k]) for p, k in self.vocabulary.ids.items()}
        scores = [s for s in self.vocabulary.scores.values() if s > -1e8]
        self.unknown_score = min(scores, default=0.0) - 10

    def _border(self, piece: str, side: int) -> list[str]:
        """What stands at one end of a piece while it is joined, from its outermost character to the whole."""
        found = self.borders.get((piece, side))
        if found is None:
            found = [piece]
            while len(found[-1]) > 1:
                found.append(self.vocabulary.joins[found[-1]][side])
            found.reverse()
            self.borders[piece, side] = found
        return found

    def _open(self, before: str, piece: str) -> bool:
        """Whether BPE leaves ``before`` and ``piece`` standing side by side.

        Both are joined step by step, best score first. They stay apart unless, at
        some step, joining across their border scores better than the next step.
        """
        if len(piece) > 1 and piece not in self.vocabulary.joins:
            return False
        if not before:
            return True
        scores = self.vocabulary.scores
        left, right, i, j = self._border(before, 1), self._border(piece, 0), 0, 0
        while True:
            across = scores.get(left[i] + right[j])
            on_left = scores[left[i + 1]] if i + 1 < len(left) else _NEVER
            on_right = scores[right[j + 1]] if j + 1 < len(right) else _NEVER
            # Of equal scores the leftmost join comes first.
            if across is not None and across > on_left and across >= on_right:
                return False
            if on_left == on_right == _NEVER:
                return True
            if on_left >= on_right:
                i += 1
            else:
                j += 1

    def _forward_bpe(self, word: str, last: list[str]) -> None:
        scores, tails, pairs, open_pair = self.vocabulary.scores, self.tails, self.pairs, self._open
        for end in range(len(last), len(word) + 1):
            for begin in range(end - 1, -1, -1):
                piece = word[begin:end]
                if begin < end - 1:
                    if piece not in tails:
                        raise ValueError(f"the scores of this vocabulary leave no segmentation for {word[:end]!r}")
                    if piece not in scores:
                        continue
                key = (last[begin], piece)
                found = pairs.get(key)
                if found is None:
                    found = self.older_pairs.get(key)
                    if found is None:
                        found = open_pair(*key)
                    if len(pairs) >= PAIRS:
                        self.older_pairs, self.pairs = pairs, {}
                        pairs = self.pairs
                    pairs[key] = found
                if found:
                    last.append(piece)
                    break

    def _forward_best(self, word: str, last: list[str], total: list[float]) -> None:
        scores, tails = self.vocabulary.scores, self.tails
        for end in range(len(last), len(word) + 1):
            best, won = None, ""
            for begin in range(end - 1, -1, -1):
                piece = word[begin:end]
                if piece not in tails and begin < end - 1:
                    break
                score = scores.get(piece, self.unknown_score if begin == end - 1 else None)
                if score is not None and (best is None or total[begin] + score >= best):
                    best, won = total[begin] + score, piece
            last.append(won)
            total.append(best)

    def _traced(self, last: list[str]) -> bytes:
        """Ids of a whole word, from its end: the last piece of a prefix tells the prefix before it."""
        end, found = len(last) - 1, []
        while end > 0:
            piece = last[end]
            found.append(self.piece_ids.get(piece) or self._ids(piece))
            end -= len(piece)
        found.reverse()
        return b"".join(found)

    def _ids(self, piece: str) -> bytes:
        """A character that is no piece is spelled in bytes."""
        v = self.vocabulary
        found = _packed([v.byte_ids[b] for b in piece.encode()] if v.byte_ids else [v.unknown])
        self.piece_ids[piece] = found
        return found

    def _spaced(self, word: str) -> bytes:
        """BPE of a word after two marks or more: all but the word's own mark are joined last, among themselves."""
        rest = word.lstrip(MARK)
        marks, tail = len(word) - len(rest), b""
        if rest:
            last = [""]
            self._forward_bpe(MARK + rest, last)
            tail, own = self._traced(last), self.piece_ids.get(MARK) or self._ids(MARK)
            if tail.startswith(own):
                tail = tail[len(own) :]
            else:
                marks -= 1
        spaces = merged_marks(marks, self.vocabulary.scores)
        return b"".join(self.piece_ids.get(p) or self._ids(p) for p in spaces) + tail

    def learn(self, words: set[str]) -> None:
        """Work out the ids of words not seen before."""
        last, total, previous = [""], [0.0], ""
        is_bpe, known = self.vocabulary.is_bpe, self.known
        for word in sorted(words):
            if is_bpe and word.startswith(MARK + MARK):
                known[word] = self._spaced(word)
                continue
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del last[shared + 1 :]
            if is_bpe:
                self._forward_bpe(word, last)
            else:
                del total[shared + 1 :]
                self._forward_best(word, last, total)
            previous = word
            known[word] = self._traced(last)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes of 32-bit integers; a null text counts as empty and has none."""
        split = [marked_words(text, self.vocabulary.dummy_prefix) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = set(chain.from_iterable(split)) - known.keys()
        again = missing & older.keys()
        known.update([(w, older[w]) for w in again])
        self.learn(missing - again)
        found = [b"".join([known[w] for w in words]) for words in split]
        for word in missing:
            if len(word) > LONGEST:
                del known[word]
        return found


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


_WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


def marked_words(text: str | None, dummy_prefix: bool) -> list[str]:
    """Spaces become marks, and the text is cut before marks and around line feeds: no piece goes on there."""
    if not text:
        return []
    marked = text.replace(" ", MARK)
    return _WORD.findall(MARK + marked if dummy_prefix else marked)


def merged_marks(count: int, scores: dict[str, float]) -> list[str]:
    """BPE of a run of marks, in whole rounds of equal pairs so that a long run takes few steps."""
    block = 512
    if count <= block:
        return merged([MARK] * count, scores)
    # Runs this long settle into the longest piece from the left.
    longest = max((len(p) for p in scores if not p.strip(MARK)), default=1)
    whole = (count - block) // longest
    return [MARK * longest] * whole + merged([MARK] * (count - whole * longest), scores)


def _with(docs: DataFrame, added: list[StructField]) -> StructType:
    names = {f.name for f in added}
    return StructType([f for f in docs.schema.fields if f.name not in names] + added)


def _extended(batch: pa.RecordBatch, added: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in added]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *added.values()], [*kept, *added])


def _spell(ids: list[int], spelled: list[bytes], dummy_prefix: bool) -> str:
    text = b"".join([spelled[i] for i in ids]).decode(errors="replace")
    return text[1:] if dummy_prefix and text.startswith(" ") else text


def encode(
    docs: DataFrame, model: str | None = None, text_col: str = "text", *, decoded: bool = False
) -> DataFrame:
    """``docs`` with ``ids`` (piece ids of the whole text) and ``n_tokens``; older columns of these names give way.

    Null and empty texts have no ids. As in SentencePiece itself a space and the
    mark U+2581 are one and the same. Rows that repeat give equal ids. With
    ``decoded`` the text that the ids spell stands beside them, as ``decode`` gives
    it, without a second pass through Python.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": vars(load(model or default_model()))})
    added = [StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType())]
    added += [StructField("decoded", StringType())] if decoded else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What a worker has learned serves its later tasks too; another worker learns it anew.
        if "encoder" not in shared.value:
            shared.value["encoder"] = Encoder(Vocabulary(**shared.value["vocabulary"]))
        encoder = shared.value["encoder"]
        for batch in chunks(batches, text_col):
            found = encoder.encode(batch.column(text_col).to_pylist())
            counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
            bounds = np.concatenate(([0], np.cumsum(counts)))
            ids = list_array(bounds, pa.array(np.frombuffer(b"".join(found), np.int32)))
            columns = {"ids": ids, "n_tokens": pa.array(counts)}
            if decoded:
                v = encoder.vocabulary
                texts = [_spell(np.frombuffer(x, np.int32).tolist(), v.spelled, v.dummy_prefix) for x in found]
                columns["decoded"] = pa.array(texts, pa.string())
            yield _extended(batch, columns)

    return docs.mapInArrow(run, _with(docs, added))


def decode(docs: DataFrame, model: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the text its ids spell; null or empty ids spell the empty text."""
    vocabulary = load(model or default_model())
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.spelled, vocabulary.dummy_prefix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled, dummy_prefix = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = []
                for ids in batch.column(ids_col):
                    pieces = ids.values.to_numpy().tolist() if ids.is_valid else []
                    texts.append(_spell(pieces, spelled, dummy_prefix))
                yield _extended(batch, {"decoded": pa.array(texts, pa.string())})

    return docs.mapInArrow(run, _with(docs, [StructField("decoded", StringType())]))


def token_report(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256, round_trip) per row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return encode(source, model, decoded=True).select(
        "doc_id",
        "ids",
        "n_tokens",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"),
    )
