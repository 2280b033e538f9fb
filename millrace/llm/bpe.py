"""BPE encoding by a bounded-lookahead streaming transducer, decoding by a byte-to-text machine.

**Encoding.** The tokens of a text's prefix that end at a token boundary are the tokens of
that prefix alone, so one token per prefix, its last, describes all encodings. A new
symbol adds one entry: the only token that ends there and may follow the entry before
it. ``Merges.may_follow`` decides that from the merge list: no merge across the border
may come up before both tokens are complete. The last token of any longer text starts within
``lookahead`` symbols (the longest token), so whatever all paths from the last
``lookahead`` entries have in common is final. It is emitted and forgotten, so the state
does not grow with the text.

**Decoding.** Tokens give bytes, and a machine holds back the bytes of a character until it is whole.

Texts are read in pieces that end before a blank. The vocabulary file is a parameter; its
bytes go to the executors once, and each worker keeps bounded stores of what it has seen
between blanks, of words, and of the transducer's states after the beginnings of words.

Letters and digits that Unicode added after the library's tables were made (a few blocks past
16.0) are cut by the newer tables of Python's pattern engine, so texts with them may differ from the library's.

Defined results: a null text is empty and has no tokens; strings of special tokens in a text
become their ids; repeated rows give repeated results; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import blocks, lean
from millrace.llm.settings import tuned

PIECE = 1 << 16
STORED = 400_000  # entries of a worker's stores that does nothing else
STORED_IN_TURN = 100_000  # of one that takes turns with those of other operators
_NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    spare = iter(range(256, 512))
    return [letters.get(b) or chr(next(spare)) for b in range(256)]


class Merges:
    """A merge list, with what follows from it: how each token came about, and which may stand side by side."""

    def __init__(self, vocab: dict[str, int], merges: Iterable, suffix: str, stored: int = STORED):
        self.suffix, self.stored = suffix, stored
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        made = {a + b: (vocab[a], vocab[b]) for a, b in pairs}
        self.left, self.right, self.born = {}, {}, {}
        for token, i in vocab.items():
            self.left[i], self.right[i] = made.get(token, (i, i))
            self.born[i] = self.rank[made[token]] if token in made else -1
        whole: dict[int, bool] = {}
        for i in sorted(self.born, key=self.born.__getitem__):  # parts before what is made of them
            a, b = self.left[i], self.right[i]
            whole[i] = self.born[i] < 0 or whole[a] and whole[b] and self.may_follow(a, b, self.born[i])
        # A token that its own text is never encoded as cannot occur at all.
        self.inner = {t: i for t, i in vocab.items() if whole[i] and not (suffix and t.endswith(suffix))}
        self.final = {t.removesuffix(suffix): i for t, i in vocab.items() if whole[i] and (not suffix or t.endswith(suffix))}
        self.lookahead = max(map(len, [*self.inner, *self.final]))
        self.follows: dict[int, bool] = {}

    def may_follow(self, a: int, b: int, limit: int = _NEVER) -> bool:
        """Whether a and b stay apart until ``limit``: walks back through the edges that met, newest first."""
        until_a = until_b = limit  # when the edge was merged into something larger
        while True:
            rank = self.rank.get((a, b))
            if rank is not None and rank < until_a and rank <= until_b and rank < limit:
                return False
            if self.born[a] < 0 and self.born[b] < 0:
                return True
            if self.born[a] > self.born[b]:
                until_a, a = self.born[a], self.right[a]
            else:
                until_b, b = self.born[b], self.left[b]

    def pair(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > 2 * self.stored:
                self.follows.clear()
            known = self.follows[key] = self.may_follow(a, b)
        return known


class Transducer:
    """Encodes one word given bit by bit: ``feed`` returns the tokens that are final, ``finish`` the rest."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.text = ""  # symbols since the last emitted boundary; the newest one waits for its successor
        self.last: list[int] = [-1]  # last token of each prefix of the text
        self.size: list[int] = [0]
        self.before = -1  # the token emitted last

    def _advance(self, i: int, tokens: dict[str, int], text: str) -> None:
        last, pair = self.last, self.merges.pair
        for j in range(max(0, i - self.merges.lookahead), i):
            token = tokens.get(text[j:i])
            if token is not None:
                previous = last[j] if j else self.before
                if previous < 0 or pair(previous, token):
                    last.append(token)
                    self.size.append(i - j)
                    return
        raise ValueError(f"no token ends at {text[max(0, i - 8):i]!r}")

    def _path(self, i: int) -> list[int]:
        out = []
        while i:
            out.append(self.last[i])
            i -= self.size[i]
        return out[::-1]

    def feed(self, symbols: str) -> list[int]:
        out: list[int] = []
        step = 8 * self.merges.lookahead
        for at in range(0, len(symbols), step):
            self.text += symbols[at : at + step]
            for i in range(len(self.last), len(self.text)):  # all but the newest
                self._advance(i, self.merges.inner, self.text)
            out += self._emit()
        return out

    def _emit(self) -> list[int]:
        """Cut at the last boundary that every path from the last ``lookahead`` prefixes passes."""
        end = len(self.last) - 1
        heads = set(range(max(0, end - self.merges.lookahead), end + 1))
        while len(heads) > 1:
            i = max(heads)
            heads.remove(i)
            heads.add(i - self.size[i])
        cut = heads.pop()
        if not cut:
            return []
        out = self._path(cut)
        self.before = self.last[cut]
        self.text = self.text[cut:]
        self.last, self.size = [-1, *self.last[cut + 1 :]], [0, *self.size[cut + 1 :]]
        return out

    def finish(self) -> list[int]:
        n = len(self.text)
        if n:
            for i in range(len(self.last), n):
                self._advance(i, self.merges.inner, self.text)
            self._advance(n, self.merges.final, self.text)
        out = self._path(n)
        self.__init__(self.merges)
        return out


class ByteText:
    """Text from tokens that arrive in any portions; a character cut by a border waits for its rest."""

    def __init__(self, pieces: list[bytes], between: bytes = b""):
        self.pieces, self.between, self.first = pieces, between, True
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.take(self.between.join([self.pieces[i] for i in ids]))

    def take(self, raw: bytes) -> str:
        """As ``feed`` for tokens whose bytes are put together already."""
        if raw and not self.first:
            raw = self.between + raw
        self.first = self.first and not raw
        return self.machine.decode(raw)

    def finish(self) -> str:
        return self.machine.decode(b"", True)


class Spelling:
    """Byte strings of tokens, laid end to end for a whole array of ids."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pa.array(pieces, pa.binary())

    def of(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        _, marks, raw = self.pieces.take(pa.array(ids)).buffers()
        return raw.slice(0, int(np.frombuffer(marks, np.int32)[len(ids)])).to_pybytes()


class Tokenizer:
    """A byte-level BPE vocabulary with word ends, read from its JSON description."""

    def __init__(self, source: bytes, stored: int = STORED):
        self.stored = stored
        spec = json.loads(source)
        model = spec["model"]
        self.letters = byte_letters()
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"] or "", stored)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = model["vocab"] | self.special
        self.names = [""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.names[i] = token
        self.named = [t.encode() for t in self.names]
        # Tokens as digests read them, each with the space that stands before it.
        self.decimals = Spelling([b" %d" % i for i in range(len(self.names))])
        self.library = Spelling([b" " + name for name in self.named])
        back = {letter: b for b, letter in enumerate(self.letters)}
        self.plain = [self._plain(i, back) for i in range(len(self.names))]
        self.readable = Spelling(self.plain)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.length = {i: len(t) for t, i in [*self.merges.inner.items(), *self.merges.final.items()]}
        self.ends: dict[str, int] = {}  # last token of a word's beginning
        self.known: dict[str, tuple] = {}  # tokens of words
        self.known_before: dict[str, tuple] = {}
        self.fresh: dict[str, bytes] = {}  # packed tokens of what stands between blanks, as it is written
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drop the remembered words and pairs; the vocabulary stays."""
        for store in (self.ends, self.known, self.known_before, self.fresh, self.older, self.merges.follows):
            store.clear()

    def _word(self, word: str) -> tuple[int, ...]:
        symbols = "".join([self.letters[b] for b in word.encode()])
        if len(symbols) > 64:
            machine = Transducer(self.merges)
            return tuple([*machine.feed(symbols), *machine.finish()])
        # The transducer's states of a short word, shared with all words that begin alike.
        if len(self.ends) > self.stored:
            self.ends.clear()
        last, ends, inner, pair = [-1], self.ends, self.merges.inner, self.merges.pair
        n = len(symbols)
        for i in range(1, n):
            head = symbols[:i]
            token = ends.get(head)
            if token is None:
                for j in range(i):
                    token = inner.get(symbols[j:i])
                    if token is not None and (not j or pair(last[j], token)):
                        ends[head] = token
                        break
            last.append(token)
        final = self.merges.final
        for j in range(n):
            token = final.get(symbols[j:])
            if token is not None and (not j or pair(last[j], token)):
                break
        out, i = [token], j
        while i:
            out.append(last[i])
            i -= self.length[last[i]]
        return tuple(out[::-1])

    def _entry(self, written: str) -> bytes:
        """Tokens of what stands between two blanks, as 32-bit numbers: all that is kept of it, since hundreds of thousands are."""
        found = self.older.get(written)
        if found is None:
            ids: list[int] = []
            for part in self.cut.split(written) if "<|" in written else (written,):
                if part in self.special:
                    ids.append(self.special[part])
                    continue
                for word in self.words.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()):
                    own = self.known.get(word)
                    if own is None:
                        own = self.known_before.get(word) or self._word(word)
                        if len(word) <= 64:
                            if len(self.known) >= self.stored // 2:
                                self.known_before, self.known = self.known, {}
                            self.known[word] = own
                    ids += own
            found = struct.pack(f"={len(ids)}i", *ids)
        if len(written) <= 64:
            if len(self.fresh) >= self.stored:
                self.older, self.fresh = self.fresh, {}
            self.fresh[written] = found
        return found

    def pieces(self, text: str) -> Iterator[np.ndarray]:
        """Tokens of a text, a bounded piece of it at a time, cut at blanks and line ends.

        No token, no special string and no composed character reaches across them.
        """
        at = 0
        while at < len(text):
            to = at + PIECE
            while to < len(text) and text[to] not in " \n":
                to += 1
            written = text[at:to].replace("\n", " ").split(" ")
            found = list(map(self.fresh.get, written))
            if None in found:
                found = [self._entry(w) if x is None else x for x, w in zip(found, written)]
            yield np.frombuffer(b"".join(found), np.int32)
            at = to

    def encode(self, text: str) -> list[int]:
        return [i for own in self.pieces(text) for i in own.tolist()]

    def library_text(self) -> ByteText:
        """Decoding as the file asks: it names no decoder, so tokens are written out with a space between."""
        return ByteText(self.named, b" ")

    def plain_text(self) -> ByteText:
        """Decoding to readable text: letters back to bytes, a word end to a space."""
        return ByteText(self.plain)

    def _plain(self, i: int, back: dict[str, int]) -> bytes:
        name, suffix = self.names[i], self.merges.suffix
        if name in self.special:
            return name.encode()
        body = name.removesuffix(suffix) if suffix else name
        return bytes(back[c] for c in body) + (b" " if body != name else b"")


_loaded: dict[tuple, Tokenizer] = {}


def _tokenizer(source, stored: int = STORED) -> Tokenizer:
    """The worker's tokenizer, built on first use."""
    raw = source.value
    key = hashlib.sha256(raw).hexdigest(), stored
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizer(raw, stored)
    return _loaded[key]


def _source(docs: DataFrame, path: str):
    """The vocabulary file's bytes (a few MB, whatever the corpus) for all executors."""
    with open(path, "rb") as file:
        return tuned(docs.sparkSession).sparkContext.broadcast(file.read())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _encoded(tokenizer: Tokenizer, rows: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of ``encode``; the ids stay packed, a Python number for each would take nine times the space."""
    ids, ends, decoded = [np.zeros(0, np.int32)], [0], []
    for text in rows.column("text").to_pylist():
        machine, parts, total = tokenizer.plain_text(), [], ends[-1]
        for own in tokenizer.pieces(text):
            ids.append(own)
            total += len(own)
            parts.append(machine.take(tokenizer.readable.of(own)))
        ends.append(total)
        decoded.append("".join([*parts, machine.finish()]))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
    return pa.record_batch([rows.column("doc_id"), pa.array(np.diff(ends), pa.int64()), lists, pa.array(decoded, pa.string())],
                           ["doc_id", "n_tokens", "ids", "decoded"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): tokens of every text, and the readable text they stand for."""
    source = _source(docs, path)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(source, STORED_IN_TURN)
        for rows, _, _ in blocks(batches, "text"):
            yield _encoded(tokenizer, rows)
        _loaded.clear()  # a worker lives on after its task, beside those of other tasks and stages

    return _texts(docs).mapInArrow(lean(apply), "doc_id bigint, n_tokens bigint, ids array<int>, decoded string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), hashed while the tokens stream past."""
    source = _source(docs, path)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(source)
        for batch in batches:
            totals, ids_out, text_out = [], [], []
            for text in batch.column("text").to_pylist():
                total, ids, decoded, machine = 0, hashlib.sha256(), hashlib.sha256(), tokenizer.library_text()
                for own in tokenizer.pieces(text):
                    if len(own):
                        ids.update(memoryview(tokenizer.decimals.of(own))[not total :])
                        decoded.update(machine.take(tokenizer.library.of(own)[1:]).encode())
                        total += len(own)
                decoded.update(machine.finish().encode())
                totals.append(total)
                ids_out.append(ids.hexdigest())
                text_out.append(decoded.hexdigest())
            yield pa.record_batch([batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(ids_out), pa.array(text_out)],
                                  ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        tokenizer.forget()

    return _texts(docs).mapInArrow(lean(apply), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
