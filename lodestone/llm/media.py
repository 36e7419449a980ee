"""Media columns: interleaved sequences of text and media references, with payloads joined by digest."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.catalog import stage
from lodestone.llm.arrow import map_batches, texts
from lodestone.llm.html_text import BLANKS, NEVER_SHOWN, VOID, tokens

WIDTH = 64
PNG = b"\x89PNG\r\n\x1a\n"
ITEM = "position:int,kind:string,text:string,ref:string,caption:string"
ITEMS = f"array<struct<{ITEM}>>"
#: A payload is told apart by this many bytes of texts at a time.
SLICE_BYTES = 16 << 20


def padded(raw: bytes) -> bytes:
    """The bytes, then zeros up to a positive multiple of 64."""
    return raw + bytes(-len(raw) % WIDTH if raw else WIDTH)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


#: A private chunk that readers may ignore and copy: how many of the samples are not padding, as an unsigned 64-bit integer.
SIZE = b"siZe"


def store_png(payload: bytes, size: int, level: int = 6) -> bytes:
    """An 8-bit greyscale PNG, 64 samples wide, whose samples are the payload's bytes, the first ``size`` of them without padding."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return PNG + _chunk(b"IHDR", head) + _chunk(SIZE, struct.pack(">Q", size)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def read_png(media: bytes) -> tuple[bytes, int]:
    """The samples of an 8-bit greyscale PNG whose lines have filter 0, as :func:`store_png` writes them, and their size without padding."""
    if media[:8] != PNG:
        raise ValueError("not a PNG")
    at, data, width, height, unpadded = 8, [], 0, 0, None
    while at < len(media):
        size, kind = struct.unpack(">I4s", media[at : at + 8])
        body = media[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", media[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("a damaged PNG")
        if kind == b"IHDR":
            width, height, depth, colour, _, _, laced = struct.unpack(">IIBBBBB", body)
            if (depth, colour, laced) != (8, 0, 0):
                raise ValueError("not 8-bit greyscale")
        elif kind == SIZE:
            (unpadded,) = struct.unpack(">Q", body)
        elif kind == b"IDAT":
            data.append(body)
        at += size + 12
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("lines are filtered")
    samples = lines[:, 1:].tobytes()
    return samples, len(samples) if unpadded is None else unpadded


def feature(payload: bytes) -> str:
    """Mean, spread and entropy of the samples and a 64-bit hash of their coarse shape."""
    x = np.frombuffer(payload, np.uint8)
    share = np.bincount(x, minlength=256) / len(x)
    mean = float(share @ np.arange(256))
    spread = float(np.sqrt(max(share @ (np.arange(256) - mean) ** 2, 0)))
    entropy = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
    edges = np.linspace(0, len(x), 65).astype(np.int64)
    sums = np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
    cells = (sums[edges[1:]] - sums[edges[:-1]]) / np.maximum(edges[1:] - edges[:-1], 1)
    bits = np.packbits(cells > mean + 1e-9).tobytes().hex()
    return f"mean={mean:.4f};std={spread:.4f};entropy={entropy:.4f};shape={bits}"


def parse_interleaved(html: str) -> list[dict]:
    """The page's texts and media references in order.

    Each <img>, <audio>, <video> or <source> with a src is an item of kind "media"; its caption is the
    <figcaption> of its figure, else its alt text. Text between media is an item of kind "text" with
    white space collapsed. What is never shown gives no text.
    """
    items: list[dict] = []
    text: list[str] = []
    hidden, figure, caption = [], None, None

    def flush():
        joined = BLANKS.sub(" ", "".join(text)).strip()
        text.clear()
        if joined:
            items.append({"position": len(items), "kind": "text", "text": joined, "ref": None, "caption": None})

    for kind, value, attrs in tokens(html):
        if kind == "text":
            if caption is not None:
                caption.append(value)
            elif not hidden:
                text.append(value)
        elif kind == "start":
            if value in ("img", "audio", "video", "source") and attrs.get("src") and not (hidden and hidden[-1] not in ("audio", "video")):
                flush()
                items.append({"position": len(items), "kind": "media", "text": None, "ref": attrs["src"], "caption": attrs.get("alt") or None})
            if value in NEVER_SHOWN and value not in VOID:
                hidden.append(value)
            elif value == "figure":
                flush()
                figure = len(items)
            elif value == "figcaption" and figure is not None:
                caption = []
            elif value not in VOID:
                text.append(" ")
        elif value in hidden:
            while hidden.pop() != value:
                pass
        elif value in ("figcaption", "figure"):
            if caption is not None and figure is not None:
                said = BLANKS.sub(" ", "".join(caption)).strip()
                for item in items[figure:]:
                    if item["kind"] == "media" and said:
                        item["caption"] = said
            caption = None
            if value == "figure":
                flush()
                figure = None
        else:
            text.append(" ")
    flush()
    return items


def interleave(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(page, doc_id, items): a number for each row, its id, and its texts and media references in order. Null pages have no items."""
    fields = [("position", pa.int32()), *((c, pa.string()) for c in ("kind", "text", "ref", "caption"))]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        items = pa.array([parse_interleaved(h) for h in texts(batch.column(2))], pa.list_(pa.struct(fields)))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], items], names=["page", "doc_id", "items"])

    own = F.col("page") if "page" in pages.columns else F.monotonically_increasing_id()
    source = pages.select(own.alias("page"), F.col(id_col).cast("long").alias("doc_id"), F.col(html_col).cast("string").alias("html"))
    return map_batches(source, run, f"page long, doc_id long, items {ITEMS}", 64)


def resolve(sequences: DataFrame, media: DataFrame) -> DataFrame:
    """One row per item of the sequences with the columns of ``media`` that its digest names, in the struct ``media``.

    ``media`` has one row per ``digest``. The join is on digests only and no payload moves: what is asked of
    payloads is computed where they are stored. Texts and references without a digest pass without it; a digest that many
    pages share is split by adaptive execution.
    """
    items = sequences.select("page", "doc_id", F.explode_outer("items").alias("item"))
    digest = F.when(F.col("item.ref").startswith("media:"), F.expr("substring(item.ref, 7)"))
    items = items.withColumn("digest", digest)
    known = media.select("digest", F.struct(*(c for c in media.columns if c != "digest")).alias("media"))
    found = items.filter("digest IS NOT NULL").join(known, "digest", "left").select("page", "doc_id", "item", "digest", "media")
    rest = items.filter("digest IS NULL").withColumn("media", F.lit(None).cast(known.schema["media"].dataType))
    return found.unionByName(rest)


def in_order(resolved: DataFrame) -> DataFrame:
    """(page, doc_id, sequence): for each page all its items again, texts and media with what was resolved, by position.

    A page's items meet in one row, as they came from one.
    """
    row = F.when(F.col("item").isNotNull(), F.struct("item.position", "item.kind", "item.text", "item.ref", "item.caption", "digest", "media"))
    # Positions are unique within a page, so nothing behind them is compared.
    together = resolved.groupBy("page", "doc_id").agg(F.collect_list(row).alias("_items"))
    ordered = F.array_sort("_items", lambda a, b: a["position"] - b["position"])
    return together.select("page", "doc_id", ordered.alias("sequence"))


def sequences(pages: DataFrame, media: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page, doc_id, sequence): the interleaved sequence of each page, media resolved in ``media`` (one row a digest).

    Defined cases: a page without items has an empty sequence; references that are no digest, or an unknown one, have a null
    ``media``; ids may be null and rows may repeat, as rows are numbered; an empty table gives no rows.
    """
    return in_order(resolve(stage(interleave(pages, id_col, html_col), "items"), media))


def page_of(doc_id, digests: list[str]) -> str:
    """A page that shows stored documents, each between two lines of text and with a caption."""
    name = escape(str(doc_id))
    shown = "".join(f"<figure><img src='media:{d}' alt='samples'><figcaption>Part {i} of document {name}</figcaption></figure><p>Text after part {i}</p>" for i, d in enumerate(digests))
    return f"<article><p>Document {name}</p>{shown}</article>"


def store_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write each text as a PNG into a table in the shared folder: page, doc_id, html, digest, media.

    ``media`` is null where the same task has lately written the digest. Texts are stored some megabytes at a time, so a task
    holds neither all of a batch's payloads nor all digests; payloads that more than one task or stretch writes are one row when read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written: set[bytes] = set()
        names = ["page", "doc_id", "html", "digest", "media"]
        for batch in batches:
            rows, held = [], 0
            for at in range(batch.num_rows):
                text = batch.column(2)[at].as_py() or ""
                raw = text.encode("utf-8", "surrogatepass")
                png = store_png(padded(raw), len(raw))
                digest = hashlib.sha256(png)
                if len(written) >= 100_000:
                    written.clear()
                new = digest.digest() not in written
                written.add(digest.digest())
                doc_id = batch.column(1)[at].as_py()
                rows.append((batch.column(0)[at].as_py(), doc_id, page_of(doc_id, [digest.hexdigest()]), digest.hexdigest(), png if new else None))
                held += len(png)
                if held >= SLICE_BYTES or at + 1 == batch.num_rows:
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0

    source = docs.select(F.monotonically_increasing_id().alias("page"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stage(source.mapInArrow(run, "page long, doc_id long, html string, digest string, media binary"), "media")


READ = "digest string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def read_media(stored: DataFrame) -> DataFrame:
    """Read the stored payloads back: one row per digest with what is asked of its bytes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for digest, media in zip(batch.column(0).to_pylist(), batch.column(1)):
            media = media.as_py()
            (payload, size), own = read_png(media), hashlib.sha256(media).hexdigest()
            if own != digest:
                raise ValueError(f"payload {digest} is damaged")
            rows.append((digest, size, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(media), own, feature(payload)))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in READ.split(", ")])

    return map_batches(stored.filter("media is not null").select("digest", "media"), run, READ).dropDuplicates(["digest"])


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as media, show it on a page, and resolve the page's sequence again: one row per document.

    The columns are those of the sequence's media item; ``position`` and ``caption`` are its own, ``n_items`` and
    ``text_after`` tell what stands beside it. Payloads are written once per task and digest and never shuffled; pages,
    digests and features are small.

    Defined cases: null text is the empty text, stored as 64 zero bytes; ids may be null and rows may repeat,
    and each row gets its own; equal texts have one digest; an empty table gives no rows; further columns are ignored.
    """
    stored = store_documents(docs, id_col, text_col)
    # A table of its own, so that the join deals both sides itself and a hot digest can be split.
    media = stage(read_media(stored), "payloads")
    whole = sequences(stored.select("page", "doc_id", "html"), media, "doc_id", "html")
    at = whole.select("doc_id", "sequence", F.filter("sequence", lambda x: x["kind"] == "media")[0].alias("shown"))
    after = F.get("sequence", F.col("shown.position") + 1)["text"]
    return at.select("doc_id", "shown.media.*", "shown.position", "shown.caption", F.size("sequence").alias("n_items"), after.alias("text_after"))
