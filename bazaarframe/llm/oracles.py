"""DuckDB counterparts of the queries that SQL can express on the whole tables.

Not here, and compared with brute force in tests/llm: language predictions, token counts, the seeded choice of the mix,
scores of the model, packed rows, and near-duplicate components over all pairs of documents.
"""

from __future__ import annotations

_OP2 = r"""
    with rows as (
        select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm
        from documents
    )
    select doc_id,
        first_value(doc_id) over best as keep_id,
        count(*) over (partition by norm) as group_size,
        row_number() over best = 1 as kept,
        sha256(norm) as text_sha256
    from rows
    window best as (partition by norm order by length(t) desc, doc_id)
"""

# Two lines within one edit agree in their first or their last half, by the length of the shorter.
_OP6 = r"""
    with texts as (
        select doc_id, str_split(coalesce(text, ''), chr(10)) as lines from documents
    ),
    numbered as (
        select doc_id, unnest(lines) as raw, unnest(range(len(lines))) as line_no from texts
    ),
    occurrences as (
        select doc_id, line_no, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as line from numbered
    ),
    firsts as (
        select line, min((doc_id, line_no)) as place, length(line) as n from occurrences where line <> '' group by line
    ),
    halves as (
        select line, place, n, unnest([n, n - 1]) // 2 as h from firsts where n >= 16
    ),
    keyed as (
        select distinct line, place, n, unnest(['a' || h || left(line, h), 'z' || h || right(line, h)]) as half from halves
    ),
    near as (
        select distinct b.line
        from keyed a join keyed b on a.half = b.half and a.place < b.place and abs(a.n - b.n) <= 1
        where levenshtein(a.line, b.line) <= 1
    ),
    removed as (
        select o.doc_id, count(*) as n, string_agg(o.line_no, ',' order by o.line_no) as numbers
        from occurrences o join firsts f using (line) left join near on near.line = o.line
        where near.line is not null or (o.doc_id, o.line_no) <> f.place
        group by o.doc_id
    )
    select t.doc_id, cast(len(t.lines) as bigint) as n_lines, coalesce(r.n, 0) as n_removed, coalesce(r.numbers, '') as removed_lines
    from texts t left join removed r using (doc_id)
"""

_OP7 = r"""
    with texts as (
        select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
    ),
    windows as (
        select doc_id, start, md5(array_to_string(words[start + 1:start + 35], ' ')) as w
        from (select doc_id, words, unnest(range(len(words) - 34)) as start from texts where len(words) >= 35)
    ),
    repeated as (
        select doc_id, start from windows where w in (select w from windows group by w having count(*) > 1)
    ),
    covered as (
        select distinct doc_id, unnest(range(start, start + 35)) as word_no from repeated
    ),
    gone as (
        select doc_id, list(word_no) as numbers from covered group by doc_id
    ),
    numbered as (
        select doc_id, unnest(words) as word, unnest(range(len(words))) as word_no from texts
    ),
    kept as (
        select n.doc_id, string_agg(n.word, ' ' order by n.word_no) as rest
        from numbered n anti join covered c on n.doc_id = c.doc_id and n.word_no = c.word_no
        group by n.doc_id
    )
    select t.doc_id, cast(len(t.words) as bigint) as n_words, cast(coalesce(len(g.numbers), 0) as bigint) as n_removed,
        sha256(coalesce(k.rest, '')) as kept_sha256
    from texts t left join gone g using (doc_id) left join kept k using (doc_id)
"""


def _merkle(levels: int = 10) -> str:
    """Hash trees over the documents, level by level, deep enough for 8**levels rows of a language."""
    framed = "||".join(
        f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{}")
    )
    plain, forged = framed.format("text", "text"), framed.format("forged", "forged")
    # The checksum of the digits of an id, bit by bit.
    crc = """xor(list_reduce([4294967295::ubigint] || [ascii(c)::ubigint for c in string_split(cast(doc_id as varchar), '')],
        lambda crc, byte: list_reduce([xor(crc, byte)] || [0::ubigint for i in range(8)],
            lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384::ubigint) else x // 2 end)), 4294967295::ubigint)"""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = [
        f"changed as (select *, case when {crc} % 3 = 0 then translate(text, '{upper}', '{lower}') else text end as forged from documents)",
        f"leaves as (select doc_id, lang, sha256({plain}) as leaf, sha256({forged}) as other from changed)",
        "ranked as (select *, dense_rank() over (order by lang nulls first) - 1 as g, "
        "row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i from leaves)",
        "n0 as (select g, i, leaf as h from ranked)",
        "p0 as (select doc_id, g, i, leaf, other as node, '' as proof from ranked)",
    ]

    def climb(k: int, group: str, nodes: str, paths: str, keep: str) -> None:
        parts.append(
            f"s{k} as (select a.*, (select count(*) from {nodes} c where c.{group} = a.{group}) as many, "
            f"coalesce((select string_agg(b.h, '' order by b.i) from {nodes} b where b.{group} = a.{group} and b.i // 8 = a.i // 8 and b.i < a.i), '') as l, "
            f"coalesce((select string_agg(b.h, '' order by b.i) from {nodes} b where b.{group} = a.{group} and b.i // 8 = a.i // 8 and b.i > a.i), '') as r "
            f"from {nodes} a)"
        )
        parts.append(
            f"n{k + 1} as (select {group}, i // 8 as i, case when min(many) = 1 then min(h) else sha256(string_agg(h, '' order by i)) end as h "
            f"from s{k} group by {group}, i // 8)"
        )
        parts.append(
            f"p{k + 1} as (select {keep}, p.i // 8 as i, case when many = 1 then node else sha256(l || node || r) end as node, "
            f"case when many = 1 then proof else proof || l || r end as proof from {paths} p join s{k} s on s.{group} = p.{group} and s.i = p.i)"
        )

    for k in range(levels):
        climb(k, "g", f"n{k}", f"p{k}", "doc_id, p.g, leaf")
    m = levels + 1
    parts.append(f"n{m} as (select 0 as t, g as i, h from n{levels})")
    parts.append(f"p{m} as (select doc_id, 0 as t, p.g as i, leaf, node, proof, h as subroot from p{levels} p join n{levels} n on n.g = p.g)")
    for k in range(m, m + 4):
        climb(k, "t", f"n{k}", f"p{k}", "doc_id, p.t, leaf, subroot")
    last = m + 4
    return (
        "with " + ",\n".join(parts) + f"\nselect doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, node as folded_root, "
        f"node = h as verified from p{last}, n{last}"
    )


ORACLES = {"op2_exact_dups": _OP2, "op6_line_dups": _OP6, "op7_passages": _OP7, "op11_merkle": _merkle()}
