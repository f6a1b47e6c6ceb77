"""Exact merge-type (BPE) encoding with a SentencePiece vocabulary, by backtracking, and decoding.

The merge procedure joins the adjacent pair whose union is the best-ranked piece, leftmost first, until no union is a
piece.  Its result is the only token sequence in which every adjacent pair survives re-merging on its own.  So an
encoder may take the longest piece at each place (all pieces found by one Aho-Corasick pass), check each new token
against the one before by re-merging the two, and step back to shorter pieces when nothing fits; a bitfield of failed
places keeps it from trying a place twice.  Re-merging two tokens needs only the pieces that touch at their border:
the later of the two tokens' merges is undone, step by step, and at no step may the border have merged earlier.

Before that, one space is put in front; the model's space mark U+2581 and a space are the same character to it, so
pieces are held here with spaces.  A piece never holds two characters that are neighbours in no piece, so the text is
cut there first, and the parts are encoded apart; as words recur, parts are remembered in a bounded table.  Characters
in no piece become their UTF-8 bytes' pieces.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ship_code

MARK, SPACE = "▁", " "
CUT = "\x01"
REMEMBERED = 200_000  # parts, and pairs, that a task remembers
LONGEST_PART = 64  # characters of a part that is remembered


class PieceCodec:
    """Encoder and decoder of one model file of the BPE kind with byte fallback, identity normalisation and a dummy
    prefix; other kinds are refused."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)  # read for its vocabulary alone
        if model.normalize("ﬁ  É ") != "▁ﬁ▁▁É▁":
            raise ValueError("a model that normalises texts isn't supported")
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.ids = {model.id_to_piece(i).replace(MARK, SPACE): i for i in plain}
        self.rank = {piece: -model.get_score(i) for piece, i in self.ids.items()}
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("a model without byte fallback isn't supported")
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.texts = [""] * len(ids)
        for piece, i in self.ids.items():
            self.texts[i] = piece
        self.kind = "H" if len(ids) <= 1 << 16 else "I"
        self.names = [str(i) for i in ids]
        self.find = ahocorasick.Automaton()
        self.halves = {p: h for p in self.ids if len(p) > 1 and (h := self._halves(p))}
        for piece, i in self.ids.items():
            if len(piece) == 1 or piece in self.halves:  # others never come out of merging
                self.find.add_word(piece, i)
        self.find.make_automaton()
        self.length = [0] * len(ids)
        self.shorter = [-1] * len(ids)  # the longest proper prefix that is a piece
        for piece, i in self.ids.items():
            self.length[i] = len(piece)
            self.shorter[i] = next((self.ids[x] for n in range(len(piece) - 1, 0, -1) if (x := piece[:n]) in self.find), -1)
        self.pieces = {i: p for p, i in self.ids.items()}
        self.part = self._parts()
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def _parts(self) -> re.Pattern:
        """Matches the stretches of a text that merges may join.  A part begins at a space mark that follows another
        character, if no piece holds a space mark after another character, and at any character of no longer piece."""
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.plain_cuts = not inner and "\n" not in joined  # single spaces and line ends can be cut without a pattern
        never = {c for c in map(chr, range(128)) if c not in joined}
        lone = "".join(re.escape(c) for c in sorted(never))
        lone = lone or r"\ud800"
        if inner:
            return re.compile(rf"[{lone}]|[^{lone}]+", re.S)
        return re.compile(rf"[{lone}]|{SPACE}*[^{SPACE}{lone}]+|{SPACE}+", re.S)

    def _halves(self, text: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes ``text``; None if merging doesn't lead to it."""
        tokens, rank, never = list(text), self.rank, float("inf")
        while len(tokens) > 2:
            ranks = [rank.get(a + b, never) for a, b in zip(tokens, tokens[1:])]
            least = min(ranks)
            if least == never:
                return None
            at = ranks.index(least)
            tokens[at:at + 2] = [tokens[at] + tokens[at + 1]]
        return (tokens[0], tokens[1]) if all(x in rank for x in tokens) else None

    def _remerges(self, a: str, b: str) -> bool:
        """Do the tokens a and b come out again when their joint text is merged?"""
        rank, halves, never = self.rank, self.halves, float("inf")
        limit = never  # the border must not have merged before this rank was reached
        while True:
            if rank.get(a + b, never) < limit:
                return False
            made_a = rank[a] if a in halves else -1
            made_b = rank[b] if b in halves else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                limit, a = made_a, halves[a][1]
            else:  # of equal merges, the left one comes first
                limit, b = made_b + 0.5, halves[b][0]

    def _fits(self, a: int, b: int) -> bool:
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        fits = self.pairs[a << 32 | b] = self._remerges(self.pieces[a], self.pieces[b])
        return fits

    def _backtrack(self, text: str) -> list[int]:
        """The tokens of ``text``, each of whose characters is a piece."""
        longest, shorter, length, known = self.find.iter_long, self.shorter, self.length, self.pairs.get
        failed = bytearray(len(text) + 1)
        tokens: list[int] = []
        at, last, i = 0, -1, next(longest(text))[1]
        while True:
            while i >= 0:
                end = at + length[i]
                if not failed[end]:
                    fits = last < 0 or known(last << 32 | i)
                    if fits or fits is None and self._fits(last, i):
                        break
                i = shorter[i]
            if i >= 0:
                tokens.append(i)
                if end == len(text):
                    return tokens
                at, last, i = end, i, next(longest(text, end))[1]
            else:
                failed[at] = 1
                i = tokens.pop()
                at -= length[i]
                last, i = tokens[-1] if tokens else -1, shorter[i]

    def _encode_part(self, part: str) -> list[int]:
        ids = self.ids
        if part in ids and len(part) == 1:
            return [ids[part]]
        if all(map(ids.__contains__, part)):
            return self._backtrack(part)
        out: list[int] = []
        for run in re.split(self._unknown(part), part):
            if run and run[0] in ids:
                out += self._backtrack(run)
            else:
                out += [self.byte_ids[b] for b in run.encode()]
        return out

    def _unknown(self, part: str) -> str:
        strange = {c for c in part if c not in self.ids}
        return "([" + "".join(map(re.escape, sorted(strange))) + "]+)"

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        if not text:
            return []
        known, out = self.known, []
        text = SPACE + text.replace(MARK, SPACE)
        if self.plain_cuts and CUT not in text and "  " not in text:
            parts = filter(None, text.replace("\n", f"{CUT}\n{CUT}").replace(SPACE, CUT + SPACE).split(CUT))
        else:
            parts = self.part.findall(text)
        for part in parts:
            ids = known.get(part)
            if ids is None:
                ids = array(self.kind, self._encode_part(part)).tobytes()
                if len(part) <= LONGEST_PART:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = ids
            out.append(ids)
        return array(self.kind, b"".join(out)).tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, runs of byte pieces read as UTF-8 (a byte that fits in no character becomes
        U+FFFD), the space put in front taken away."""
        texts, byte_of = self.texts, self.byte_of
        if byte_of.keys().isdisjoint(ids):
            text = "".join(map(texts.__getitem__, ids))
        else:
            out, run = [], bytearray()
            for i in ids:
                b = byte_of.get(i)
                if b is not None:
                    run.append(b)
                    continue
                if run:
                    out.append(_utf8(bytes(run)))
                    run.clear()
                out.append(texts[i])
            out.append(_utf8(bytes(run)))
            text = "".join(out)
        return text[1:] if ids and texts[ids[0]][:1] == " " else text


def _utf8(run: bytes) -> str:
    """Each byte that begins no whole character becomes one U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[at:at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                at += 1
        return "".join(out)


_CODECS: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """One codec for each worker process and model."""
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]


def encode_documents(docs: DataFrame, model_file: str, with_ids: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, with ``with_ids`` ids and decoded, and
    the columns ``carry`` (whole numbers) of the row.

    Null and empty texts have no ids (digests of the empty string).  Ids and repeated rows need no care, as each row is
    encoded by itself; null doc_ids stay null; other columns are ignored; an empty table gives no rows.  A very long
    text is held by one task, with about ten bytes a character.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids + "".join(f", {c} long" for c in carry)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(model_file)
        names = coder.names
        for batch in batches:
            rows = []
            for text in batch.text:
                ids = coder.encode(text or "")
                decoded = coder.decode(ids)
                row = (len(ids), hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                rows.append(row + ((ids, decoded) if with_ids else ()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids)
            out.insert(0, "doc_id", batch.doc_id.astype("Int64"))
            yield out.assign(**{c: batch[c].astype("Int64") for c in carry})

    ship_code(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text", *carry).mapInPandas(run, schema)


def default_model() -> str:
    """The installed 32,000-piece BPE model; any other file's path can be passed instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
