"""SentencePiece BPE encoding by a table of each prefix's last token, and decoding by the library."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
# Where no token has a space after another character, every space after one starts a piece.
SPACES_THEN_REST = rf"{SPACE}*[^{SPACE}]+|{SPACE}+"
WHOLE = r"(?s:.+)"
CACHED_PIECES = 400_000  # per Python worker
CACHED_LENGTH = 48


class PrefixEncoder:
    """Encodes as the sentencepiece library does with a BPE model with byte fallback.

    In a BPE encoding every prefix that ends at a token's end is encoded by the tokens up to there, so a prefix has
    one last token at most. Of the tokens that end at a position, found by an automaton, it is the one compatible with
    the last token of the prefix before it. Tokens are recovered from the end backwards.
    """

    def __init__(self, model: bytes) -> None:
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("only models with byte fallback are supported")
        normal = [
            i for i in range(len(pieces)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        ]
        self.ids = {pieces[i]: i for i in normal}
        by_score = sorted(normal, key=lambda i: -sp.get_score(i))
        # Merges that make the same score rank alike: the left one goes first.
        self.rank, last = {}, None
        for i in by_score:
            if sp.get_score(i) != last:
                last, level = sp.get_score(i), len(self.rank)
            if len(pieces[i]) > 1:
                self.rank[pieces[i]] = level
        self.halves: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in sorted(self.ids, key=len):
            if len(piece) == 1 or self.reachable(piece):
                self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.characters = {p for p in self.ids if len(p) == 1}
        self.inner = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.pieces = re.compile(SPACES_THEN_REST if not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids) else WHOLE).findall
        self.fits: defaultdict[str, dict[str, bool]] = defaultdict(dict)  # by left, then right token
        self.known: dict[str, list[int]] = {}

    def reachable(self, piece: str) -> bool:
        """Merges a piece's characters by rank, leftmost first; keeps the last merge if the piece itself results."""
        parts = list(piece)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == 1 << 60:
                return False
            if len(parts) == 2:
                self.halves[piece] = (parts[0], parts[1])
                return True
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def compatible(self, left: str, right: str) -> bool:
        """Whether the encoding of ``left + right`` is these two tokens.

        Undoes the merges along their border, latest first. The border holds unless two parts that meet there would
        have merged before the merge that was just undone.
        """
        rank, halves = self.rank, self.halves
        limit = 1 << 60
        while True:
            if rank.get(left + right, 1 << 60) < limit:
                return False
            a = rank[left] if left in halves else -1
            b = rank[right] if right in halves else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, halves[left][1]
            else:  # of equal merges the right one came later, and one across the border would come before it
                limit, right = b + 1, halves[right][0]

    def tokens(self, part: str) -> list[str]:
        """Tokens of a text that starts a piece, of characters that the vocabulary knows."""
        fits = self.fits
        last: list[str | None] = [None] * (len(part) + 1)
        after: list[dict[str, bool] | None] = [None] * (len(part) + 1)  # the tests known for last[i]
        for end, token in self.automaton.iter(part):
            end += 1
            if last[end] is None:
                start = end - len(token)
                if start:
                    tests = after[start]
                    fit = tests.get(token)
                    if fit is None:
                        fit = tests[token] = self.compatible(last[start], token)
                    if not fit:
                        continue
                last[end] = token
                after[end] = fits[token]
        out, at = [], len(part)
        while at:
            token = last[at]
            out.append(token)
            at -= len(token)
        out.reverse()
        return out

    def part_ids(self, part: str) -> list[int]:
        if not self.characters.issuperset(part):
            return [self.byte_ids[b] for b in part.encode()]  # cut off as a single character
        return [self.ids[token] for token in self.tokens(part)]

    def piece_ids(self, piece: str) -> list[int]:
        """Cuts a piece between characters that stand side by side in no token, and encodes the parts."""
        inner, known = self.inner, self.known
        out: list[int] = []
        start = 0
        for i in range(1, len(piece) + 1):
            if piece[i - 1 : i + 1] not in inner:
                part = piece[start:i]
                start = i
                found = known.get(part)
                if found is None:
                    found = self.part_ids(part)
                    self.keep(part, found)
                out += found
        return out

    def keep(self, part: str, ids: list[int]) -> None:
        if len(part) <= CACHED_LENGTH:
            if len(self.known) >= CACHED_PIECES:
                self.known.clear()
            self.known[part] = ids

    def encode(self, text: str) -> list[int]:
        known, ids = self.known, []
        normal = self.library.normalize(text)
        for piece in self.pieces(normal):
            found = known.get(piece)
            if found is None:
                found = self.piece_ids(piece)
                self.keep(piece, found)
            ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_encoders: dict[str, PrefixEncoder] = {}


def encoder_of(model: bytes) -> PrefixEncoder:
    """One encoder per model and Python worker."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = PrefixEncoder(model)
    return _encoders[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (array<int>), decoded (the text that the ids give back).

    ``model`` is the content of a SentencePiece BPE model file; it is read on the driver and broadcast, a fixed half
    megabyte. Null texts count as empty, and empty texts have no ids. Repeated rows repeat; an empty table gives an
    empty table. Texts of any length are encoded whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                ids = [encoder.encode(t) if t else [] for t in part.column(1).to_pylist()]
                decoded = [encoder.decode(i) if i else "" for i in ids]
                arrays = [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded documents."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def public_model(name: str) -> bytes:
    """A model among the public tokenizer files."""
    import public_tokenizers

    return read_model(public_tokenizers.path(name))
