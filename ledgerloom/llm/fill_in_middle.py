"""Fill-in-the-middle reordering of texts, as a pipeline of ``pyarrow.compute`` per Arrow batch.

1. Every text becomes a list array of its units (code points): the places where a code
   point begins are the offsets of the unit strings over the text's own bytes.
2. The lists are flattened, with the index of each unit's text; its ordinal is its place
   less the place of the text's first unit.
3. Two cuts give each unit a role: prefix, middle or suffix. Units are filtered by role, put
   back into lists and joined with ``binary_join``; the pieces of a text are joined by its form.

A text of more than ``PART_BYTES`` goes through this in parts, whose ordinals go on from
each other and whose pieces are joined once more, so a very long text takes no more memory
than its pieces.

Cuts and forms are drawn from the SHA-256 of ``seed:id``, so they are the same on every run
and for every repeated row of an id.

Defined results: a null text is an empty one; an empty text, one that holds a marker, and the
share that is not drawn stay ``plain``, with null piece lengths; a null id is drawn as
the empty string; equal rows get equal results, one by one; an empty table gives no rows;
columns other than the two named ones are not used, whatever they are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import table, text_batches

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
PART_BYTES = 1 << 20
FORMS = "id {id}, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(id_col: Column, seed: str = "1") -> list[Column]:
    """Four unsigned 32-bit numbers of an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def unit_pieces(data: np.ndarray, starts: np.ndarray, cuts: tuple[pa.Array, pa.Array], base: int = 0) -> list[pa.Array]:
    """Prefix, middle and suffix of each text of a block; ordinals begin at ``base``."""
    held = pa.array(data)
    begins = pc.indices_nonzero(pc.not_equal(pc.bit_wise_and(held, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8())))
    offsets = pa.concat_arrays([begins.cast(pa.int32()), pa.array([len(data)], pa.int32())])
    units = pa.StringArray.from_buffers(len(begins), offsets.buffers()[1], pa.py_buffer(data))
    firsts = pa.array(np.searchsorted(begins.to_numpy(), starts).astype(np.int32))
    units = pa.ListArray.from_arrays(firsts, units)
    flat, text = pc.list_flatten(units), pc.list_parent_indices(units)
    ordinal = pc.add(pc.subtract(pa.array(np.arange(len(flat))), pc.take(firsts, text).cast(pa.int64())), base)
    role = pc.add(*(pc.greater_equal(ordinal, pc.take(cut, text)).cast(pa.int8()) for cut in cuts))
    out = []
    for one in range(3):
        mine = pc.equal(role, one)
        counts = np.bincount(pc.filter(text, mine).to_numpy(), minlength=len(starts) - 1)
        out.append(pc.binary_join(ws.lists_of(pc.filter(flat, mine), counts), ""))
    return out


def _parts(data: np.ndarray, starts: np.ndarray):
    """A block as it is, or one long text in parts, with the units before each of them."""
    if len(starts) > 2 or len(data) <= PART_BYTES:
        yield data, starts, 0
        return
    base, a = 0, 0
    while a < len(data):
        b = min(len(data), a + PART_BYTES)
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        yield data[a:b], np.array([0, b - a]), base
        base += int(((data[a:b] & 0xC0) != 0x80).sum())
        a = b


def reorder(texts: pa.Array, numbers: list[pa.Array], plain_from: int, spm_below: int):
    """Per block of texts: first and last row, n, form, the two piece lengths, and the output."""
    for first, last, data, starts in ws.blocks(texts):
        size = last - first
        text = pc.fill_null(texts.slice(first, size), "")
        n = pc.utf8_length(text).cast(pa.int64())
        h1, h2, h3, h4 = (x.slice(first, size).to_numpy() for x in numbers)
        ends = np.sort(np.stack([h1 % (n.to_numpy() + 1), h2 % (n.to_numpy() + 1)]), axis=0)
        marked = pc.or_(pc.or_(*(pc.match_substring(text, m) for m in MARKERS[:2])), pc.match_substring(text, MARKERS[2]))
        plain = pc.or_(pc.or_(pc.equal(n, 0), marked), pa.array(h3 % 100 >= plain_from))
        cuts = tuple(pa.array(x) for x in ends)
        parts = [unit_pieces(*part[:2], cuts, part[2]) for part in _parts(data, starts)]
        prefix, middle, suffix = parts[0] if len(parts) == 1 else (pc.binary_join(ws.lists_of(pa.concat_arrays(x), np.array([len(x)])), "") for x in zip(*parts))
        form = pc.case_when(pc.make_struct(plain, pa.array(h4 % 100 < spm_below)), "plain", "spm", "psm")
        psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
        spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
        output = pc.case_when(pc.make_struct(plain, pc.equal(form, "spm")), text, spm, psm)
        lengths = [pc.if_else(plain, pa.scalar(None, pa.int64()), x) for x in (cuts[0], pc.subtract(*cuts[::-1]))]
        yield first, last, n, form, *lengths, output


def _reorder_task(plain_from: int, spm_below: int):
    @ws.released
    def run(batches):
        for batch in batches:
            for first, last, *columns in reorder(batch.column(1), batch.columns[2:6], plain_from, spm_below):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *columns], names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that outputs were made from."""
    parts = {}
    for name, order in (("psm", (PREFIX, SUFFIX, MIDDLE)), ("spm", (SUFFIX, PREFIX, MIDDLE))):
        # rows of other forms are emptied, and get the markers only so that they split alike
        own = pc.if_else(pc.equal(form, name), output, "".join(order))
        rest, found = pc.utf8_slice_codeunits(own, len(order[0])), {}
        for marker, after in zip(order, order[1:]):
            pair = pc.split_pattern(rest, after, max_splits=1)
            found[marker], rest = pc.list_element(pair, 0), pc.list_element(pair, 1)
        found[order[-1]] = rest
        parts[name] = pc.binary_join_element_wise(found[PREFIX], found[MIDDLE], found[SUFFIX], "")
    which = pc.make_struct(pc.equal(form, "psm"), pc.equal(form, "spm"))
    return pc.case_when(which, parts["psm"], parts["spm"], output)


@ws.released
def _restore_task(batches):
    for batch in batches:
        for first, last, _, _ in ws.blocks(batch.column(2)):
            own = batch.slice(first, last - first)
            yield own.append_column("text", restored(own.column(2), own.column(1)))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """Per document: ``id_col``, n, form, prefix_chars, middle_chars and output.

    ``rate`` of a hundred documents are reordered, ``spm_rate`` of a hundred of these with
    the suffix first.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), *draws(F.col(f"`{id_col}`"), seed))
    kind = docs.schema[id_col].dataType.simpleString()
    return own.mapInArrow(_reorder_task(rate, spm_rate), FORMS.format(id=kind)).withColumnRenamed("id", id_col)


def restore_texts(moved: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, form, output and, from these two alone, the text."""
    kind = moved.schema[id_col].dataType.simpleString()
    own = moved.select(F.col(f"`{id_col}`").alias("id"), "form", "output")
    return own.mapInArrow(_restore_task, f"id {kind}, form string, output string, text string").withColumnRenamed("id", id_col)


def op11_fill_in_middle(spark, d):
    moved = fill_in_middle(table(spark, d, "documents"))
    # the pieces' lengths travel beside the output, so both digests come of one pass
    packed = moved.select(F.struct("doc_id", "n", "prefix_chars", "middle_chars").alias("of"), "form", "output")
    with text_batches(spark):
        back = restore_texts(packed, "of")
        return back.select("of.doc_id", "of.n", "form", "of.prefix_chars", "of.middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


OP11_SQL = """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
h as (select doc_id, t, length(t) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
p as (select *, substring(t, 1, a) as pre, substring(t, a + 1, b - a) as mid, substring(t, b + 1) as suf from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(case form when 'plain' then t else pre || mid || suf end) as restored_sha256
from p
"""
