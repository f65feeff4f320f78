"""Exact merge-type (BPE) encoding with SentencePiece models, and decoding.

Method. A text is cut where no piece of the vocabulary can cross: before a run
of word marks, and around characters that are in no longer piece. Each part is
encoded by backtracking: one Aho-Corasick pass finds the pieces that end at
each place; from the left, the longest piece is tried first; a piece may follow
its neighbour only if merging their joined text from characters gives exactly
these two pieces; a bitfield remembers the positions from which no way leads to
the end of the part. A sequence whose neighbours are all compatible is the one
that merging by score makes, so the result is the library's.

Characters outside the vocabulary become byte pieces, or the unknown id where
a model has none.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import arrow_map, batch, prepare, texts_of

MARK = "▁"
#: Parts kept by a worker, in two generations of so many each.
_CACHED_PARTS = 250_000
_CACHED_PAIRS = 100_000
_CACHED_CHARS = 40


class Pieces:
    """A model's pieces, with encode() and decode(). The model must use merges, identity normalisation and a dummy prefix."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or not spec.add_dummy_prefix or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only merge-type models with identity normalisation and a dummy prefix are supported")
        self.id, self.score, self.byte, self.text, self.unk = {}, {}, {}, [], 0
        for i, p in enumerate(model.pieces):
            self.text.append(p.piece)
            if p.type in (1, 5):
                self.id[p.piece], self.score[p.piece] = i, p.score
            elif p.type == 6:
                self.byte[int(p.piece[3:5], 16)] = i
            elif p.type == 2:
                self.unk = i
            elif p.type == 4:
                raise ValueError("user-defined pieces are not supported")
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.control = {i for i, p in enumerate(model.pieces) if p.type == 3}
        self.unk_surface = model.trainer_spec.unk_surface if model.trainer_spec.HasField("unk_surface") else " ⁇ "
        self.auto = ahocorasick.Automaton()
        for p in self.id:
            if len(p) > 1:  # single characters stand for themselves
                self.auto.add_word(p, 1 - len(p))
        self.auto.make_automaton()
        #: No piece has a mark after another character: parts can end before a run of marks.
        self.cut_marks = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id)
        self.cut_lines = not any("\n" in p and len(p) > 1 for p in self.id)
        self.pattern = re.compile(rf"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+" if self.cut_marks and self.cut_lines else r"(?s).+")
        #: Two characters that stand together in no piece part a text.
        self.inside = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.older_pairs: dict[tuple[str, str], bool] = {}
        self.wholes: dict[str, bool] = {}
        self.id_text = {p: f"{i}," for p, i in self.id.items()}
        self.known_ids: dict[str, str] = _Parts(self._ids_text)
        #: Parts whose ids decode to another text than the part itself (with blanks for marks).
        self.altered = 0

    def merged(self, text: str) -> list[str]:
        """The pieces that merging by score makes of a short text: the best pair first, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the joined text gives exactly these two. Kept in two generations."""
        key = (a, b)
        ok = self.pairs.get(key)
        if ok is None:
            ok = self.older_pairs.get(key)
            if ok is None:
                ok = self.merged(a + b) == [a, b]
            if len(self.pairs) >= _CACHED_PAIRS:
                self.older_pairs = self.pairs
                self.pairs = {}
            self.pairs[key] = ok
        return ok

    def whole(self, piece: str) -> bool:
        """Whether merging the piece's characters gives the piece: one answer for each of the vocabulary."""
        ok = self.wholes.get(piece)
        if ok is None:
            ok = self.wholes[piece] = self.merged(piece) == [piece]
        return ok

    def split(self, text: str) -> list[str]:
        """The pieces, as strings, of one part. Single characters stand for themselves also outside the vocabulary."""
        n = len(text)
        if n < 2:
            return [text] if n else []
        if text in self.id and self.whole(text):
            return [text]
        longest = list(range(1, n + 1))  # the end of the longest piece from each place; shorter ones come first
        for end, back in self.auto.iter(text):
            longest[end + back] = end + 1
        failed, known, pairs = bytearray(n // 8 + 1), self.id, self.pairs
        at, out, sizes = 0, [], []
        size = longest[0]
        while at < n:
            while size:
                end = at + size
                piece = text[at:end]
                if (size == 1 or piece in known) and not failed[end >> 3] >> (end & 7) & 1:
                    if out:
                        ok = pairs.get((out[-1], piece))
                        if ok is None:
                            ok = self.compatible(out[-1], piece)
                    else:
                        ok = size == 1 or self.whole(piece)
                    if ok:
                        break
                size -= 1
            if size:
                out.append(piece)
                sizes.append(size)
                at = end
                size = longest[at] - at if at < n else 0
            else:
                # the way to this place is the only valid one, so from here no way leads to the end
                failed[at >> 3] |= 1 << (at & 7)
                out.pop()
                size = sizes.pop()
                at -= size
                size -= 1
        return out

    def part_ids(self, part: str) -> list[int]:
        out = []
        for p in self.split(part):
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            elif self.byte:
                out.extend(self.byte[b] for b in p.encode())
            else:
                out.append(self.unk)
        return out

    def _ids_text(self, part: str) -> str:
        inside = self.inside
        cuts = [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in inside]
        if cuts:
            known = self.known_ids
            return "".join([known[part[a:z]] for a, z in zip([0, *cuts], [*cuts, len(part)], strict=True)])
        try:  # the joined pieces are the part itself
            return "".join([self.id_text[p] for p in self.split(part)])
        except KeyError:  # a character outside the vocabulary
            ids = self.part_ids(part)
            if self.surface(ids) != part.replace(MARK, " "):
                self.altered += 1
            return "".join([f"{i}," for i in ids])

    def surface(self, ids) -> str:
        """The text of ids with marks as blanks; a prefix blank is kept. Bytes that are no UTF-8 give U+FFFD each."""
        out, held = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(_utf8(held))
                held.clear()
            out.append("" if i in self.control else self.unk_surface if i == self.unk else self.text[i].replace(MARK, " "))
        if held:
            out.append(_utf8(held))
        return "".join(out)

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        if self.cut_marks and self.cut_lines and "  " not in text and MARK not in text and not text.startswith(" "):
            return (MARK + text.replace(" ", " " + MARK).replace("\n", " \n ")).split(" ")
        return self.pattern.findall(MARK + text.replace(" ", MARK))

    def encode_text(self, text: str) -> tuple[str, str]:
        """(ids, each followed by a comma; decoded text)."""
        parts = self.parts(text)
        ids = "".join(map(self.known_ids.__getitem__, parts))
        # every part's ids have been decoded when they were made; where all gave the part, so does the whole
        back = self.surface([int(x) for x in ids.split(",")[:-1]]) if self.altered else "".join(parts).replace(MARK, " ")
        return ids, back[1:] if back.startswith(" ") else back

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.encode_text(text)[0].split(",")[:-1]]

    def decode(self, ids) -> str:
        text = self.surface(ids)
        first = next((i for i in ids if i not in self.control), None)
        return text[1:] if first is not None and first not in self.byte_of and text.startswith(" ") and self.text[first].startswith(MARK) else text


def _utf8(held: bytearray) -> str:
    """As UTF-8; each byte that can't be part of a character becomes U+FFFD."""
    out, i, b = [], 0, bytes(held)
    while i < len(b):
        size = 1 if b[i] < 0x80 else 2 if 0xC2 <= b[i] < 0xE0 else 3 if 0xE0 <= b[i] < 0xF0 else 4 if 0xF0 <= b[i] < 0xF5 else 0
        try:
            out.append(b[i : i + size].decode() if size and i + size <= len(b) else "�")
            i += size if out[-1] != "�" or size == 3 and b[i : i + 3] == b"\xef\xbf\xbd" else 1
        except UnicodeDecodeError:
            out.append("�")
            i += 1
    return "".join(out)


class _Parts(dict):
    """Results by part in two generations: the older one is dropped when the newer is full. Long parts aren't kept: memory stays bounded."""

    def __init__(self, make):
        super().__init__({"": ""})
        self.make, self.old = make, {}

    def __missing__(self, part):
        out = self.old.get(part)
        if out is None:
            out = self.make(part)
        if len(part) <= _CACHED_CHARS:
            if len(self) >= _CACHED_PARTS:
                self.old = dict(self)
                self.clear()
                self[""] = ""
            self[part] = out
        return out


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, keep_text: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Encode and decode each text: id, the columns to carry, n_tokens, ids_sha256, decoded_sha256, and the ids and the decoded text if wanted.

    One narrow pass: no exchange, bounded Arrow batches. Null and empty texts
    have no ids and decode to an empty text; repeated rows are encoded each; other columns of
    docs are not read. model_path must be readable on every executor.
    """
    prepare(docs.sparkSession)
    fields = [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")]
    fields += [("ids", pa.list_(pa.int32()), "array<int>")] * keep_ids + [("decoded", pa.string(), "string")] * keep_text
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *[F.col(c) for c in carry])
    own = to_arrow_schema(source.drop("text").schema)
    schema = pa.schema([*own, *[pa.field(n, t) for n, t, _ in fields]])

    def run(batches):
        model = pieces(model_path)
        for b in batches:
            n, ids_sha, text_sha, all_ids, all_text = [], [], [], [], []
            for text in texts_of(b.column(1)):
                ids, back = model.encode_text(text)
                ids = ids[:-1]
                n.append(ids.count(",") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(back.encode()).hexdigest())
                if keep_ids:
                    all_ids.append([int(x) for x in ids.split(",")] if ids else [])
                if keep_text:
                    all_text.append(back)
            yield batch(schema, b.column(0), *[b.column(2 + i).cast(own.field(1 + i).type) for i in range(len(carry))], n, ids_sha, text_sha, *[all_ids] * keep_ids, *[all_text] * keep_text)

    ddl = T.StructType([*source.drop("text").schema, *T._parse_datatype_string(", ".join(f"{n} {t}" for n, _, t in fields))])
    return arrow_map(source, run, ddl).withColumnRenamed("id", id_col)
