"""The registered queries of this subpackage: ``opN_<name>`` and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from emporia.llm import (
    backoff, bags, bpe, cdc, decontaminate, exact, quality, runindex, secrets, simple8b, superminhash,
    tiles, toxicity,
)
from emporia.llm.common import with_batches
from emporia.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with_batches(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content-defined chunking of all documents; repeated passages lose their later copies.

    Runs of 64 bytes in chunks of 16 bytes and 16 more on average: a
    passage of 50 words holds such a run whatever stands around it.
    """
    found = cdc.substring_dedup(table(spark, sf_dir, "documents"), min_run=64, mask_bits=4, shortest=16)
    return found.drop("kept_text")


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blob ledger over all documents, starting empty; findings joined back to every document."""
    found, _ = secrets.scan(table(spark, sf_dir, "documents"))
    return secrets.report(found)


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and minimum-covariance-determinant outliers per language and source, small groups by their language."""
    return quality.quality(table(spark, sf_dir, "documents"), pooled=True)


@query
def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple-8b store of all documents' ids, written and read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return simple8b.token_output(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by the transducer and decoded again."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), outputs=False)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier chain fitted on at most 16,384 labelled rows; all documents scored."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 400-byte strings that start more than once, removed from all documents."""
    return runindex.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items within a fifth of their words of a stretch of any document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found)


@query
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram stupid backoff of every document against all others."""
    return backoff.backoff_scores(table(spark, sf_dir, "documents"), order=3)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


def _secret_branch(kind_no: int, rule: secrets.Rule) -> str:
    """Spans of one rule: starts from the lengths of the stretches between matches and of the matches before."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  select doc_id, {kind_no} as k, '{rule.kind}' as kind, s, s + length(m[i]) as e
  from (select *, coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)
               + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as s
        from (select doc_id, m, p, v, unnest(generate_series(1, len(m))) as i
              from (select doc_id, regexp_extract_all(t, '{pattern}') as m, string_split_regex(t, '{pattern}') as p,
                      regexp_extract_all(t, '{pattern}', {rule.group}) as v from d) a) b) c
  where length(v[i]) >= {rule.least}"""


ORACLES["op6_secret_scan"] = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
spans as ({" union all ".join(_secret_branch(k, r) for k, r in enumerate(secrets.RULES))}),
per as (select doc_id, {", ".join(f"count(*) filter (where kind = '{r.kind}') as n_{r.kind}" for r in secrets.RULES)},
          string_agg(kind || ':' || cast(s as varchar) || ':' || cast(e as varchar), ',' order by s, k) as spans
        from spans group by doc_id)
select d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in secrets.RULES)},
  sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from d left join per on per.doc_id = d.doc_id"""

ORACLES["op1_near_dedup"] = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
sh as (
  select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as g
  from (select doc_id, ws, unnest(generate_series(1, len(ws) - 4)) as i from w where len(ws) >= 5) a
  union all select doc_id, array_to_string(ws, ' ') from w where len(ws) between 1 and 4),
n as (select doc_id, count(*) as n from sh group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.g = b.g and a.doc_id < b.doc_id
          group by 1, 2),
links as (select x, y from pairs join n nx on nx.doc_id = x join n ny on ny.doc_id = y
          where 100 * c >= 75 * (nx.n + ny.n - c)),
both_ways as (select x as a, y as b from links union all select y, x from links),
reach(node, seen) as (select doc_id, doc_id from documents
                      union select r.node, l.b from reach r join both_ways l on l.a = r.seen),
comp as (select node, min(seen) as c from reach group by node)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c as component_id, d.doc_id = c as kept
from documents d left join n on n.doc_id = d.doc_id join comp on comp.node = d.doc_id"""

if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length, beginning, whole digest: groups of equal texts of all documents; the largest doc_id stays."""
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op13_exact_dedup"] = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
           from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
from d window same as (partition by t)"""


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item, scored once per class of equal bags."""
    return bags.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLES["op12_lexical_search"] = f"""
with d as (select doc_id, {_TERMS} as ts from documents),
lens as (select doc_id, len(ts) as n from d where len(ts) > 0),
total as (select count(*) as nd, cast(sum(n) as bigint) as l from lens),
q as (select item_id, term, count(*) as times from (select item_id, unnest({_TERMS}) as term from benchmark) a group by 1, 2),
tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(ts) as term from d) b
       where term in (select term from q) group by 1, 2),
w as (select term, cast(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) as bigint) as w from tf, total group by term, nd),
part as (select tf.doc_id, tf.term, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * lens.n * nd) // l))) as part
         from tf join lens on lens.doc_id = tf.doc_id join w on w.term = tf.term, total),
score as (select item_id, doc_id, cast(sum(part * times) as bigint) as score from part join q on q.term = part.term group by 1, 2)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from score where score > 0 qualify rank <= 10"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language over all documents, counted in tiles."""
    return tiles.collocations(table(spark, sf_dir, "documents"), least=30, top=2000)


ORACLES["op11_collocations"] = r"""
with p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece
           from (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') as t from documents) d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
g as (select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase
      from (select lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) as i
            from w, (values (1), (2), (3), (4)) as v(k) where len(ws) >= k) a),
f as (select lang, phrase, k, count(*) as a from g group by 1, 2, 3 having count(*) >= 30),
total as (select lang, sum(len(ws)) as n from w group by lang),
cand as (select lang, phrase, k, a, string_split(phrase, ' ') as ws from f where k >= 2),
part as (select lang, phrase, k, a, ws, unnest(generate_series(1, k - 1)) as c from cand),
cut as (select part.lang, part.phrase, part.k, part.a, c, x.a as l, y.a as r,
          cast((2000000 * cast(part.a as hugeint)) // (x.a + y.a) as bigint) as score
        from part join f x on x.lang = part.lang and x.phrase = array_to_string(ws[1:c], ' ')
                  join f y on y.lang = part.lang and y.phrase = array_to_string(ws[c + 1:], ' ')),
scored as (select * from cut qualify row_number() over (partition by lang, phrase order by score, c) = 1),
inner_ as (select lang, array_to_string(ws[i:i + m - 1], ' ') as phrase, max(a) as most
           from (select lang, ws, k, a, m, unnest(generate_series(1, k - m + 1)) as i
                 from cand, (values (2), (3)) as v(m) where m < k) b group by 1, 2)
select s.lang, row_number() over (partition by s.lang order by score desc, s.a desc, s.phrase) as rank,
  s.phrase, s.a, l, r, cast(n as bigint) as n, score
from scored s join total on total.lang = s.lang left join inner_ i on i.lang = s.lang and i.phrase = s.phrase
where most is null or 100 * most < 80 * s.a qualify rank <= 2000"""
