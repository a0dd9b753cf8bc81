"""SentencePiece BPE encoding and decoding by a merge-type prefix table.

For every prefix of a text the table keeps the one token that ends it in the
encoding of that prefix. The candidates are the vocabulary pieces that an
Aho-Corasick automaton finds ending there; the right one is the candidate whose
left neighbour (the last token of the prefix before it) is compatible with it:
the two encode, on their own, to just these two. The ids are then read backwards
from the end of the table.

Why this is exact: merging always takes the best-scored adjacent pair, leftmost
first, so what happens inside two neighbouring tokens is ordered the same way
whatever stands around them. A sequence is therefore the encoding of its text
if and only if each token encodes to itself and each adjacent pair to itself.

Texts are cut where no vocabulary piece can reach across (before a run of word
marks, around characters that no piece holds); the parts are encoded alone
and remembered in a bounded cache.

Nulls count as empty text; an empty text has the begin and end ids only. Only
the id column and the text column of the input are read, so other columns may
have any name.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from clinicflow.llm.common import ship

MARK = "▁"
CACHE_WORDS = 1_000_000
CACHE_PAIRS = 1_000_000


class PrefixTableBpe:
    """Encoder and decoder over a BPE vocabulary file of the sentencepiece library.

    The library only reads the file (pieces, scores, kinds); it encodes nothing here.
    """

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.vocab_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.normalize = sp.normalize
        self.identity = self._identity(sp)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.surface: list[bytes] = [b""] * n
        self.byte_of: dict[int, int] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.byte_of[i] = value
                self.surface[i] = bytes([value])
            elif sp.is_unknown(i):
                self.surface[i] = sp.decode([i]).encode("utf-8")
            elif not sp.is_control(i):
                self.ids[piece] = i
                self.scores[piece] = sp.get_score(i)
                self.surface[i] = piece.replace(MARK, " ").encode("utf-8")
        automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            automaton.add_word(piece, (i, len(piece)))
        automaton.make_automaton()
        self.automaton = automaton
        inner_mark = [p for p in self.ids if p.strip(MARK) and MARK in p.lstrip(MARK)]
        known = {c for p in self.ids for c in p}
        klass = "".join(regex.escape(c) for c in sorted(known - {MARK}))
        # A part: word marks and what follows them; any character that no piece holds stands alone.
        self.splitter = (
            regex.compile(rf"{MARK}*[{klass}]+|{MARK}+|[^{klass}{MARK}]") if not inner_mark else regex.compile(r"(?s).+")
        )
        # First a plain cut at word marks and line ends, so that most parts are found in the cache as they are.
        lines = "\n" not in known and not inner_mark
        self.words = re.compile(r" *[^ \n]+| +|\n") if lines else re.compile(r"(?s).+")
        self.cache: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.size = n
        self.known = known
        self.every_char = all(c in self.ids for c in known)
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.lengths = [len(p) for p in self.pieces]
        # Pieces that encode to themselves; any other can't end a prefix.
        self.whole = [p in self.ids and len(self.merge(p)) == 1 for p in self.pieces]

    @staticmethod
    def _identity(sp) -> bool:
        probe = "  aﬁ ① Ａé  \t\r\n　x  "
        return sp.normalize(probe) == MARK + probe.replace(" ", MARK)

    # ---- pair compatibility

    def merge(self, text: str) -> list[str]:
        """Plain merging, best score first and leftmost on ties: used on single pieces and pairs of pieces."""
        parts: list[str | None] = list(text)
        nxt = list(range(1, len(parts) + 1))
        prev = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if 0 <= i and j < len(parts):
                joined = parts[i] + parts[j]
                score = self.scores.get(joined)
                if score is not None:
                    heapq.heappush(heap, (-score, i, j, joined))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, j, joined = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or nxt[i] != j or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            nxt[i] = nxt[j]
            if nxt[i] < len(parts):
                prev[nxt[i]] = i
                offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        return [p for p in parts if p is not None]

    def compatible(self, left: int, right: int) -> bool:
        """Whether two pieces side by side encode to just these two. Remembered by their joint number."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        a, b = self.pieces[left], self.pieces[right]
        known = self.pairs[left * self.size + right] = self.merge(a + b) == [a, b]
        return known

    # ---- prefix table

    def last_tokens(self, part: str) -> list[int]:
        """For each prefix of ``part`` the last token of its encoding (at the prefix's length; -1 before the text).

        Every character of ``part`` must be a piece, so that exactly one candidate fits at each place.
        """
        last = [-1] * (len(part) + 1)
        pairs, size, compatible, whole = self.pairs, self.size, self.compatible, self.whole
        done = 0
        for end, (token, length) in self.automaton.iter(part):
            end += 1
            if end == done or not whole[token]:
                continue
            start = end - length
            if start:
                left = last[start]
                ok = pairs.get(left * size + token)
                if not (compatible(left, token) if ok is None else ok):
                    continue
            last[end] = token
            done = end
        return last

    def encode_part(self, part: str) -> bytes:
        if not self.every_char or part[0] not in self.known:
            return self._encode_plainly(part)
        last = self.last_tokens(part)
        out: list[int] = []
        end, lengths = len(part), self.lengths
        while end:
            token = last[end]
            out.append(token)
            end -= lengths[token]
        out.reverse()
        return array("I", out).tobytes()

    def _encode_plainly(self, part: str) -> bytes:
        """Characters outside the vocabulary become byte pieces (or the unknown piece)."""
        out: list[int] = []
        for piece in self.merge(part):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8"))
            else:
                out.append(self.unk)
        return array("I", out).tobytes()

    def encode_bytes(self, text: str | None) -> bytes:
        """All ids with begin and end, as little-endian unsigned 32-bit integers."""
        begin, end = array("I", (self.bos,)).tobytes(), array("I", (self.eos,)).tobytes()
        if not text:
            return begin + end
        norm = " " + text.replace(MARK, " ") if self.identity else self.normalize(text).replace(MARK, " ")
        parts = self.words.findall(norm)
        got = list(map(self.cache.get, parts))
        if None in got:
            got = [g if g is not None else self._missing(p) for g, p in zip(got, parts)]
        return b"".join((begin, *got, end))

    def _missing(self, words: str) -> bytes:
        part = words.replace(" ", MARK)
        if self.known.issuperset(part):
            got = self.encode_part(part)
        else:
            got = b"".join(map(self.encode_part, self.splitter.findall(part)))
        if len(part) <= 64:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[words] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        return array("I", self.encode_bytes(text)).tolist()

    # ---- decoding

    def decode(self, ids) -> str:
        """Pieces joined; byte pieces form characters (an invalid byte gives U+FFFD); the dummy space goes."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            text = self._lenient(ids)
        first = next((i for i in ids if i not in (self.bos, self.eos)), None)
        if first is not None and first not in self.byte_of and text.startswith(" "):
            text = text[1:]
        return text

    def _lenient(self, ids) -> str:
        out: list[str] = []
        run = bytearray()

        def flush() -> None:
            k = 0
            while k < len(run):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[k : k + width]).decode("utf-8"))
                    except UnicodeDecodeError:
                        continue
                    k += width
                    break
                else:
                    out.append("�")
                    k += 1
            run.clear()

        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
            else:
                flush()
                out.append(self.surface[i].decode("utf-8"))
        flush()
        return "".join(out)


_models: dict[str, PrefixTableBpe] = {}


def load(model_path: str) -> PrefixTableBpe:
    """The model of a path, loaded once in each Python worker."""
    if model_path not in _models:
        _models[model_path] = PrefixTableBpe(model_path)
    return _models[model_path]


def encode_documents(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """One row per document: its id, ``n_tokens``, the ids and the decoded text with their SHA-256.

    ``with_ids=False`` leaves out the ids and the decoded text. One pass, no shuffle.
    """
    ship(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_col]

    def run(batches):
        bpe = load(model_path)
        for batch in batches:
            n, sha, ids_out, back_sha, back_out = [], [], [], [], []
            for scalar in batch.column(1):
                raw = bpe.encode_bytes(scalar.as_py())
                ids = array("I", raw)
                text = bpe.decode(ids)
                n.append(len(ids))
                sha.append(hashlib.sha256(raw).hexdigest())
                back_sha.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
                if with_ids:
                    ids_out.append(ids.tolist())
                    back_out.append(text)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back_sha, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(back_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""
    return docs.select(id_col, text_col).mapInArrow(run, schema)
