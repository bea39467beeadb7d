"""Chat formatting with typed content parts (operator 7).

A visitor has one method per kind of part and returns, for a part, what stands in the text, the
attachment it records and the tokens it expands to. Texts are escaped so that no control string of
the template (or of the common instruction templates) can occur in them; a backslash is put behind
the first character of such a string, and backslashes are doubled, so the text can be read back.
A conversation comes out as ordered pieces, one per turn, with their offsets: no conversation is ever
collected, and reading back streams over sorted pieces.

Defined cases: a null text or part list counts as empty; an unknown or null kind of part is rendered
as an escaped text part; turns without a number come first; rows of the same turn are ordered by role
and content, repeated rows all stay; a null role is an empty one; a null conversation id is a
conversation of its own; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyspark.llm.common import small_batches

START, END = "<|turn|>", "</s>\n"
# FIXED: strings that control templates; none can be read in an escaped text.
CONTROLS = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
ESCAPED = r"\\|(?<=<)(?=\||/?s>|</?SYS>>)|(?<=\[)(?=/?INST\])"
PIECE = re.compile(re.escape(START) + r"((?:[^\\\n]|\\.)*)\n(.*)" + re.escape(END), re.S)
PARTS = ("array<struct<kind string, text string, ref string, width int, height int, seconds double, pages int>>")
FLAT = "struct<piece string, kind string, ref string, tokens long>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"\\$0")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


class PartVisitor:
    """What a part of each kind becomes. Subclass to change placeholders or token counts."""

    #: Image pixels per token side, tokens per second of audio, tokens per page of a document.
    PATCH, PER_SECOND, PER_PAGE = 28, 25, 512

    def visit(self, part: Column) -> Column:
        out = self.text(part)
        for kind in ("image", "audio", "document"):
            out = F.when(part["kind"] == kind, getattr(self, kind)(part)).otherwise(out)
        return out

    def _flat(self, piece: Column, kind: Column, ref: Column, tokens: Column) -> Column:
        return F.struct(piece.alias("piece"), kind.alias("kind"), ref.alias("ref"),
                        tokens.cast("long").alias("tokens"))

    def _attached(self, part: Column, tokens: Column) -> Column:
        piece = F.concat(F.lit("<|"), part["kind"], F.lit("|>"))
        return self._flat(piece, part["kind"], part["ref"], F.greatest(F.coalesce(tokens, F.lit(1)), F.lit(1)))

    def text(self, part: Column) -> Column:
        none = F.lit(None).cast("string")
        return self._flat(escape(F.coalesce(part["text"], F.lit(""))), none, none, F.lit(0))

    def image(self, part: Column) -> Column:
        return self._attached(part, F.ceil(part["width"] / self.PATCH) * F.ceil(part["height"] / self.PATCH))

    def audio(self, part: Column) -> Column:
        return self._attached(part, F.ceil(part["seconds"] * self.PER_SECOND))

    def document(self, part: Column) -> Column:
        return self._attached(part, part["pages"].cast("long") * self.PER_PAGE)


def text_parts(text: Column) -> Column:
    """A list of one text part."""
    none = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"),
                                                      ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"), *none))


def format_chats(messages: DataFrame, parts: Column, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", visitor: PartVisitor | None = None,
                 learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn in conversation order.

    ``id_col``, ``place`` (from 0), ``role``, ``piece`` (the turn as formatted), ``start`` (its offset in
    the conversation), ``loss_start`` and ``loss_end`` (in the piece; null where nothing is learned),
    ``attachments`` (kind, ref, order and expanded tokens of every placeholder) and ``n_expanded``.
    """
    visitor = visitor or PartVisitor()
    flat = F.transform(F.coalesce(parts.cast(PARTS), F.array().cast(PARTS)), visitor.visit)
    role = F.coalesce(F.col(role_col), F.lit(""))
    head = F.concat(F.lit(START), F.regexp_replace(escape(role), "\n", "\\\\\\\n"), F.lit("\n"))
    rows = messages.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
                           head.alias("head"), flat.alias("flat"))
    body = F.array_join(F.col("flat.piece"), "")
    attached = F.filter("flat", lambda p: p["kind"].isNotNull())
    rows = rows.select(
        "conv", "turn", "role", F.char_length("head").alias("loss_start"), F.concat("head", body, F.lit(END)).alias("piece"),
        F.transform(attached, lambda p, k: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), k.alias("order"),
                                                    p["tokens"].alias("tokens"))).alias("attachments"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "piece")
    length = F.char_length("piece")
    learn = F.col("role").isin(list(learned))
    return rows.select(
        F.col("conv").alias(id_col), (F.row_number().over(order) - 1).alias("place"), "role", "piece",
        (F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, 0)) - length).alias("start"),
        F.when(learn, F.col("loss_start")).alias("loss_start"),
        F.when(learn, length - len(END)).alias("loss_end"), "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("n_expanded"))


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of turns and of the text under the loss mask, parsed from the formatted pieces."""
    small_batches(formatted.sparkSession)
    names = [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None

        def done(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        def row() -> tuple:
            return key, now[0], now[1].hexdigest(), now[2], now[3].hexdigest(), now[4]

        for batch in batches:
            kind, out = batch.column(0).type, []
            for conv, piece, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != key:
                    if now is not None:
                        out.append(row())
                    key, now = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = PIECE.fullmatch(piece).groups()
                now[0] += 1
                now[1].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                if start is not None:
                    loss = unescape(piece[start:end])
                    now[2] += len(loss)
                    now[3].update(loss.encode())
                now[4] += len(piece)
            if out:
                yield done(out)
        if now is not None:
            yield done([row()])

    kind = formatted.schema[id_col].dataType.simpleString()
    # format_chats has dealt the rows by conversation and sorted them; asking again adds no shuffle.
    rows = formatted.select(id_col, "place", "piece", "loss_start", "loss_end").repartition(id_col)
    return (rows.sortWithinPartitions(id_col, "place").drop("place")
            .mapInArrow(run, f"`{id_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                             "loss_sha256 string, formatted_chars long"))
