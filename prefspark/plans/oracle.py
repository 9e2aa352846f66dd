"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans and, where the Spark form is clever, in a
different form: pre-order by a recursive CTE, batch ids by a global ``row_number``,
GAE as a self-join double sum, cyclic successors by ``lead``.
"""

from __future__ import annotations

NL = "chr(10)"

# ---------------------------------------------------------------- fixture CTEs

def turn_id(conv: str = "conv_id", turn: str = "turn") -> str:
    return f"CAST(({conv} + {turn}) * ({conv} + {turn} + 1) // 2 + {turn} AS BIGINT)"


C1 = f"""
c1_base AS (
  SELECT CAST(floor(conv_id / 4) AS BIGINT) AS tree_id, conv_id, turn, text,
         CASE WHEN role = 'user' THEN 'prompter' ELSE role END AS role
  FROM conversations WHERE role <> 'system'),
c1_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn,
         lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_turn,
         dense_rank() OVER (PARTITION BY tree_id ORDER BY conv_id) AS conv_rank,
         min(conv_id) OVER (PARTITION BY tree_id) AS root_conv
  FROM c1_base),
c1_rooted AS (
  SELECT *, min(CASE WHEN rn = 1 AND conv_id = root_conv THEN {turn_id()} END)
              OVER (PARTITION BY tree_id) AS root_id
  FROM c1_ranked),
c1 AS (
  SELECT tree_id, {turn_id()} AS id,
         CAST(CASE WHEN rn = 1 AND conv_id = root_conv THEN NULL
                   WHEN rn = 1 THEN root_id
                   ELSE {turn_id('conv_id', 'prev_turn')} END AS BIGINT) AS parent_id,
         CAST(CASE WHEN rn = 1 AND conv_id = root_conv THEN 0
                   WHEN rn = 1 THEN conv_rank ELSE 1 END AS INTEGER) AS ord,
         role, text
  FROM c1_rooted),
walk(tree_id, id, path) AS (
  SELECT tree_id, id, CAST([] AS INTEGER[]) FROM c1 WHERE parent_id IS NULL
  UNION ALL
  SELECT c.tree_id, c.id, list_append(w.path, c.ord) FROM c1 c JOIN walk w ON c.parent_id = w.id)"""

C2 = f"""
c2_u AS (SELECT conv_id, turn, text AS prompt FROM conversations WHERE role = 'user'),
c2_a AS (SELECT conv_id, turn - 1 AS turn, text AS chosen FROM conversations WHERE role = 'assistant'),
c2_p AS (SELECT u.conv_id, u.turn, {turn_id('u.conv_id', 'u.turn')} AS pair_id, prompt, chosen
         FROM c2_u u JOIN c2_a a ON u.conv_id = a.conv_id AND u.turn = a.turn),
c2 AS (SELECT pair_id, conv_id, turn, prompt, chosen,
              coalesce(lead(chosen) OVER (ORDER BY conv_id, turn),
                       first_value(chosen) OVER (ORDER BY conv_id, turn)) AS rejected
       FROM c2_p)"""


def block(role: str, text: str) -> str:
    return f"'<|im_start|>' || {role} || {NL} || {text} || '<|im_end|>'"


def prompt_sql(text: str) -> str:
    return f"'<|im_start|>user' || {NL} || {text} || '<|im_end|>' || {NL} || '<|im_start|>assistant' || {NL}"


def pair_sql(prompt: str, answer: str) -> str:
    return (f"'<|im_start|>user' || {NL} || {prompt} || '<|im_end|>' || {NL} || "
            f"'<|im_start|>assistant' || {NL} || {answer} || '<|im_end|>' || {NL}")


SQL: dict[str, str] = {}

SQL["chatml_conversations"] = f"""
SELECT conv_id, string_agg({block('role', 'text')}, {NL} ORDER BY turn) || {NL} AS text,
       count(*) AS n_messages
FROM conversations GROUP BY conv_id"""

SQL["tree_preorder"] = f"""
WITH RECURSIVE {C1}
SELECT c.tree_id, c.id, c.parent_id, CAST(len(w.path) AS BIGINT) AS depth,
       row_number() OVER (PARTITION BY c.tree_id ORDER BY w.path) - 1 AS preorder
FROM c1 c JOIN walk w ON c.id = w.id"""

SQL["chatml_trees"] = f"""
WITH RECURSIVE {C1}
SELECT c.tree_id,
       '<|im_start|>system' || {NL} || 'You are a helpful assistant.<|im_end|>' || {NL} ||
       string_agg({block("CASE c.role WHEN 'prompter' THEN 'user' ELSE c.role END", 'c.text')}, {NL} ORDER BY w.path)
       || {NL} AS text,
       count(*) AS n_messages
FROM c1 c JOIN walk w ON c.id = w.id GROUP BY c.tree_id"""

SQL["role_map"] = f"""
WITH {C1}
SELECT tree_id, id, CASE role WHEN 'prompter' THEN 'user' WHEN 'assistant' THEN 'assistant' END AS role
FROM c1"""

SQL["render_prompt"] = f"SELECT item_id, {prompt_sql('text')} AS prompt FROM benchmark"

SQL["preference_texts"] = f"""
WITH {C2}
SELECT pair_id, {prompt_sql('prompt')} AS prompt,
       {pair_sql('prompt', 'chosen')} AS chosen,
       {pair_sql('prompt', 'rejected')} AS rejected,
       {prompt_sql('prompt')} || {pair_sql('prompt', 'chosen')} AS chosen_input,
       {prompt_sql('prompt')} || {pair_sql('prompt', 'rejected')} AS rejected_input
FROM c2"""

# ---------------------------------------------------------------- tokens (TK1-TK11)

TOK = r"regexp_extract_all(regexp_replace({t}, '(<\|[a-z_]+\|>)', ' \1 ', 'g'), '[^ \t\r\n]+')"


def tok(t: str) -> str:
    return TOK.format(t=t)


VOCAB = f"""
v_tok AS (SELECT unnest({tok(block('role', 'text'))}) AS token FROM conversations),
v_cnt AS (SELECT token, count(*) AS count FROM v_tok
          WHERE token NOT IN ('<pad>', '<unk>', '<bos>', '<eos>', '<|im_start|>', '<|im_end|>') GROUP BY token HAVING count(*) >= 2),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY count DESC, token) + 5 AS BIGINT) AS id, CAST(count AS BIGINT) AS count
  FROM v_cnt
  UNION ALL SELECT '<pad>', 0, 0 UNION ALL SELECT '<unk>', 1, 0 UNION ALL SELECT '<bos>', 2, 0
  UNION ALL SELECT '<eos>', 3, 0 UNION ALL SELECT '<|im_start|>', 4, 0 UNION ALL SELECT '<|im_end|>', 5, 0)"""


def encoded(name: str, source: str, keys: str, text: str, max_length: int | None = None) -> str:
    """CTE ``name(keys..., ids INT list, n_tokens)``: word ids by vocabulary lookup, unknown -> 1."""
    lim = f"WHERE e.pos <= {max_length}" if max_length else ""
    return f"""
{name}_t AS (SELECT {keys}, {tok(text)} AS toks FROM {source}),
{name}_x AS (SELECT {keys}, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos, len(toks) AS n_tokens
             FROM {name}_t),
{name}_j AS (SELECT e.*, coalesce(v.id, 1) AS id FROM {name}_x e LEFT JOIN vocab v ON e.token = v.token {lim}),
{name} AS (SELECT {keys}, list(CAST(id AS INTEGER) ORDER BY pos) AS ids, CAST(max(n_tokens) AS BIGINT) AS n_tokens
           FROM {name}_j GROUP BY {keys})"""


def ids_str(x: str) -> str:
    return f"array_to_string({x}, ' ')"


SQL["vocab"] = f"WITH {VOCAB} SELECT token, id, count FROM vocab"

SQL["encode"] = f"""
WITH {VOCAB}, {encoded('enc', 'conversations', 'conv_id, turn', 'text')}
SELECT conv_id, turn, {ids_str('ids')} AS input_ids, n_tokens FROM enc"""

SQL["truncate"] = f"""
WITH {VOCAB}, {encoded('enc', 'conversations', 'conv_id, turn', 'text', 32)}
SELECT conv_id, turn, {ids_str('ids')} AS input_ids, CAST(len(ids) AS BIGINT) AS length, n_tokens FROM enc"""

SQL["decode"] = f"""
WITH {VOCAB},
d_t AS (SELECT conv_id, turn, {tok('text')} AS toks FROM conversations),
d_x AS (SELECT conv_id, turn, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM d_t)
SELECT d.conv_id, d.turn, coalesce(string_agg(v.token, ' ' ORDER BY d.pos), '') AS text
FROM d_x d LEFT JOIN vocab v ON d.token = v.token AND v.id > 5
GROUP BY d.conv_id, d.turn"""

SQL["prompt_length"] = f"""
WITH {C2}
SELECT pair_id, CAST(len({tok(prompt_sql('prompt'))}) AS BIGINT) AS prompt_len FROM c2"""

SQL["pad_batch"] = f"""
WITH {VOCAB},
chat AS (SELECT conv_id, string_agg({block('role', 'text')}, {NL} ORDER BY turn) || {NL} AS text
         FROM conversations GROUP BY conv_id),
{encoded('enc', 'chat', 'conv_id', 'text')},
b AS (SELECT conv_id, ids,
             (row_number() OVER (ORDER BY md5(CAST(conv_id AS VARCHAR) || ':42'), conv_id) - 1) // 4 AS batch_id
      FROM enc),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS width FROM b)
SELECT conv_id, CAST(batch_id AS BIGINT) AS batch_id,
       {ids_str('list_resize(ids, width, 0)')} AS input_ids,
       {ids_str('list_resize(list_transform(ids, lambda x: 1), width, 0)')} AS attention_mask,
       {ids_str('list_transform(list_resize(ids, width, 0), lambda x: CASE WHEN x = 0 THEN -100 ELSE x END)')} AS labels
FROM m"""

PAIR_TEXTS = f"""
pt AS (SELECT pair_id, {pair_sql('prompt', 'chosen')} AS chosen, {pair_sql('prompt', 'rejected')} AS rejected
       FROM c2)"""


def shaped(max_length: int) -> str:
    return f"""{PAIR_TEXTS},
{encoded('ec', 'pt', 'pair_id', 'chosen', max_length)},
{encoded('er', 'pt', 'pair_id', 'rejected', max_length)},
sp AS (SELECT ec.pair_id, ec.ids AS c_ids, er.ids AS r_ids FROM ec JOIN er ON ec.pair_id = er.pair_id)"""


SQL["shape_pairs"] = f"""
WITH {C2}, {VOCAB}, {shaped(512)}
SELECT pair_id, {ids_str('c_ids')} AS input_ids_chosen, {ids_str('list_transform(c_ids, lambda x: 1)')} AS attention_mask_chosen,
       {ids_str('r_ids')} AS input_ids_rejected, {ids_str('list_transform(r_ids, lambda x: 1)')} AS attention_mask_rejected,
       CAST(c_ids = r_ids AS BIGINT) AS degenerate
FROM sp"""

SQL["pad_pairs"] = f"""
WITH {C2}, {VOCAB}, {shaped(512)},
b AS (SELECT *, (row_number() OVER (ORDER BY md5(CAST(pair_id AS VARCHAR) || ':42'), pair_id) - 1) // 4 AS batch_id
      FROM sp),
m AS (SELECT *, max(greatest(len(c_ids), len(r_ids))) OVER (PARTITION BY batch_id) AS width FROM b)
SELECT pair_id, CAST(batch_id AS BIGINT) AS batch_id,
       {ids_str('list_resize(c_ids, width, 0)')} AS input_ids_chosen,
       {ids_str('list_resize(list_transform(c_ids, lambda x: 1), width, 0)')} AS attention_mask_chosen,
       {ids_str('list_resize(r_ids, width, 0)')} AS input_ids_rejected,
       {ids_str('list_resize(list_transform(r_ids, lambda x: 1), width, 0)')} AS attention_mask_rejected
FROM m"""

SQL["degenerate_pairs"] = f"""
WITH {C2}, {VOCAB}, {shaped(8)}
SELECT pair_id, CAST(c_ids = r_ids AS BIGINT) AS degenerate FROM sp"""

SQL["response_tokens"] = f"""
WITH {C2}, {VOCAB},
{encoded('ep', 'c2', 'pair_id', 'prompt')},
{encoded('ea', 'c2', 'pair_id', 'chosen')}
SELECT ep.pair_id, {ids_str('list_concat(ep.ids, ea.ids)')} AS full_ids, {ids_str('ea.ids')} AS new_ids,
       CAST(len(ea.ids) AS BIGINT) AS n_new
FROM ep JOIN ea ON ep.pair_id = ea.pair_id"""

# ---------------------------------------------------------------- batching (BA1-BA3)

SQL["assign_batches"] = f"""
WITH {C2},
e AS (SELECT pair_id, CAST(unnest(range(0, 2)) AS BIGINT) AS epoch FROM c2),
i AS (SELECT pair_id, epoch,
             row_number() OVER (PARTITION BY epoch ORDER BY md5(CAST(pair_id AS VARCHAR) || ':42:' || CAST(epoch AS VARCHAR)),
                                pair_id) - 1 AS idx
      FROM e)
SELECT pair_id, epoch, CAST(idx AS BIGINT) AS idx, CAST(idx // 4 AS BIGINT) AS batch_id,
       CAST(epoch * (((SELECT count(*) FROM c2) + 3) // 4) + idx // 4 + 1 AS BIGINT) AS step
FROM i"""

SQL["plan_steps"] = f"""
WITH {C2}
SELECT count(*) AS n_rows, CAST(2 AS BIGINT) AS batch_size, CAST(10 AS BIGINT) AS num_epochs,
       CAST(ceil(count(*) / 2) * 10 AS BIGINT) AS steps FROM c2"""

# ---------------------------------------------------------------- sampling, log-probs, losses

C3 = f"""
c3_p AS (SELECT token, count(*) AS n_policy
         FROM (SELECT unnest({tok('text')}) AS token FROM conversations WHERE role = 'assistant') GROUP BY token),
c3_r AS (SELECT token, count(*) AS n_ref FROM (SELECT unnest({tok('text')}) AS token FROM documents) GROUP BY token),
c3_u AS (SELECT coalesce(p.token, r.token) AS token, coalesce(n_policy, 0) AS n_policy, coalesce(n_ref, 0) AS n_ref
         FROM c3_p p FULL OUTER JOIN c3_r r ON p.token = r.token),
c3_s AS (SELECT CAST(sum(n_policy) AS DOUBLE) AS np, CAST(sum(n_ref) AS DOUBLE) AS nr, CAST(count(*) AS DOUBLE) AS v
         FROM c3_u),
c3 AS (SELECT token, ln((n_policy + 1) / ((SELECT np FROM c3_s) + (SELECT v FROM c3_s))) AS policy_lp,
              ln((n_ref + 1) / ((SELECT nr FROM c3_s) + (SELECT v FROM c3_s))) AS ref_lp FROM c3_u),
c3_d AS (SELECT ln(1 / (np + v)) AS dp, ln(1 / (nr + v)) AS dr FROM c3_s)"""

LONG_LOGITS = """
e_long AS (SELECT vec_id AS seq_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS item,
                  CAST(unnest(embedding) AS DOUBLE) AS logit, len(embedding) AS width FROM embeddings)"""

NUCLEUS = f"""{LONG_LOGITS},
n_z AS (SELECT *, exp(logit / 0.7 - max(logit / 0.7) OVER (PARTITION BY seq_id)) AS ez FROM e_long),
n_p AS (SELECT seq_id, item, ez / sum(ez) OVER (PARTITION BY seq_id) AS prob FROM n_z),
n_r AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY seq_id ORDER BY prob DESC, item
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
               row_number() OVER (PARTITION BY seq_id ORDER BY prob DESC, item) AS rank FROM n_p),
nucleus AS (SELECT * FROM n_r WHERE before < 0.9)"""


def r6(x: str) -> str:
    # the same IEEE operations as the Spark side (see functions.exprs.round6)
    return f"(floor(CAST({x} AS DOUBLE) * 1000000.0 + 0.5) / 1000000.0 + 0.0)"


SQL["nucleus"] = f"""
WITH {NUCLEUS}
SELECT seq_id, item, {r6('prob')} AS prob, CAST(rank AS BIGINT) AS rank FROM nucleus"""

SQL["sample_one"] = f"""
WITH {NUCLEUS},
g AS (SELECT seq_id, item,
             ln(prob) - ln(-ln((CAST(('0x' || substr(md5(CAST(seq_id AS VARCHAR) || ':' || CAST(item AS VARCHAR) || ':42'),
                                              1, 8)) AS UBIGINT) + 0.5) / 4294967296.0)) AS score
      FROM nucleus)
SELECT seq_id, arg_max(item, score) AS item FROM g GROUP BY seq_id"""

SQL["token_logps"] = f"""
WITH {LONG_LOGITS},
m AS (SELECT seq_id, max(logit) AS mx FROM e_long GROUP BY seq_id),
s AS (SELECT x.seq_id, m.mx + ln(sum(exp(x.logit - m.mx))) AS lse FROM e_long x JOIN m ON x.seq_id = m.seq_id
      GROUP BY x.seq_id, m.mx)
SELECT x.seq_id, x.item AS label, {r6('x.logit - s.lse')} AS logp
FROM e_long x JOIN s ON x.seq_id = s.seq_id WHERE x.item = x.seq_id % x.width"""

SQL["shift_labels"] = f"""
WITH {VOCAB}, {encoded('enc', 'conversations', 'conv_id, turn', 'text')},
x AS (SELECT conv_id, turn, CAST(generate_subscripts(ids, 1) - 1 AS BIGINT) AS pos, unnest(ids) AS token FROM enc),
l AS (SELECT *, lead(token) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS label FROM x)
SELECT conv_id, turn, pos, CAST(token AS BIGINT) AS token, CAST(label AS BIGINT) AS label FROM l
WHERE label IS NOT NULL"""

SEQ = f"""
s_in AS (SELECT pair_id, 0 AS side, {prompt_sql('prompt')} AS ptxt,
                {prompt_sql('prompt')} || {pair_sql('prompt', 'chosen')} AS inp FROM c2
         UNION ALL
         SELECT pair_id, 1 AS side, {prompt_sql('prompt')} AS ptxt,
                {prompt_sql('prompt')} || {pair_sql('prompt', 'rejected')} AS inp FROM c2),
s_t AS (SELECT pair_id, side, len({tok('ptxt')}) AS plen, list_slice({tok('inp')}, 1, 512) AS toks FROM s_in),
s_x AS (SELECT pair_id, side, plen, len(toks) AS slen, unnest(toks) AS token,
               generate_subscripts(toks, 1) - 1 AS pos FROM s_t),
s_a AS (SELECT x.pair_id, x.side, x.plen, x.slen,
               avg(CASE WHEN x.pos >= x.plen + 1 THEN coalesce(c.policy_lp, (SELECT dp FROM c3_d)) END) AS pl,
               avg(CASE WHEN x.pos >= x.plen + 1 THEN coalesce(c.ref_lp, (SELECT dr FROM c3_d)) END) AS rl
        FROM s_x x LEFT JOIN c3 c ON x.token = c.token
        GROUP BY x.pair_id, x.side, x.plen, x.slen),
seqlp AS (SELECT pair_id, side, coalesce(pl, 0.0) AS policy_logp, coalesce(rl, 0.0) AS ref_logp,
                 CAST(plen >= slen - 1 AS BIGINT) AS response_cut FROM s_a),
dpo AS (SELECT pair_id,
               max(CASE WHEN side = 0 THEN policy_logp END) AS policy_chosen,
               max(CASE WHEN side = 1 THEN policy_logp END) AS policy_rejected,
               max(CASE WHEN side = 0 THEN ref_logp END) AS ref_chosen,
               max(CASE WHEN side = 1 THEN ref_logp END) AS ref_rejected
        FROM seqlp GROUP BY pair_id),
dpo_l AS (SELECT *, (policy_chosen - policy_rejected) - (ref_chosen - ref_rejected) AS margin FROM dpo),
dpo_loss AS (SELECT *, -(CASE WHEN 0.1 * margin < 0 THEN 0.1 * margin - ln(1 + exp(0.1 * margin))
                              ELSE -ln(1 + exp(-0.1 * margin)) END) AS loss FROM dpo_l)"""

SQL["sequence_logps"] = f"""
WITH {C2}, {C3}, {SEQ}
SELECT pair_id, CAST(side AS BIGINT) AS side, {r6('policy_logp')} AS policy_logp, {r6('ref_logp')} AS ref_logp,
       response_cut FROM seqlp"""

SQL["dpo_loss"] = f"""
WITH {C2}, {C3}, {SEQ}
SELECT pair_id, {r6('policy_chosen')} AS policy_chosen, {r6('policy_rejected')} AS policy_rejected,
       {r6('ref_chosen')} AS ref_chosen, {r6('ref_rejected')} AS ref_rejected,
       {r6('margin')} AS margin, {r6('loss')} AS loss FROM dpo_loss"""

SQL["eval_loss"] = f"""
WITH {C2}, {C3}, {SEQ},
sp AS (SELECT CASE WHEN CAST(('0x' || substr(md5(CAST(pair_id AS VARCHAR)), 1, 2)) AS INTEGER) < 51
                   THEN 'test' ELSE 'train' END AS split, loss FROM dpo_loss)
SELECT split, {r6('avg(loss)')} AS mean_loss, count(*) AS n_rows FROM sp GROUP BY split"""

SQL["pairwise_loss"] = f"""
WITH d AS (SELECT d.doc_id, l.quality, {tok('d.text')} AS toks FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT doc_id, quality,
             CASE WHEN len(toks) = 0 THEN 0.0 ELSE 10.0 * len(list_distinct(toks)) / len(toks) END AS score,
             row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS k FROM d),
n AS (SELECT count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 0) AS bad FROM s),
p AS (SELECT greatest(g.k, b.k) AS pair_id, g.doc_id AS chosen_doc, b.doc_id AS rejected_doc, g.score AS rc, b.score AS rr
      FROM s g, s b, n WHERE g.quality = 1 AND b.quality = 0
        AND ((n.good >= n.bad AND b.k = g.k % n.bad) OR (n.good < n.bad AND g.k = b.k % n.good)))
SELECT CAST(pair_id AS BIGINT) AS pair_id, chosen_doc, rejected_doc, {r6('rc')} AS reward_chosen,
       {r6('rr')} AS reward_rejected, {r6('ln(1 + exp(-(rc - rr)))')} AS loss FROM p"""

SQL["score_texts"] = f"""
WITH {C2}, both_texts AS (SELECT pair_id, prompt || chosen AS text FROM c2)
SELECT pair_id,
       {r6(f"CASE WHEN len({tok('text')}) = 0 THEN 0.0 ELSE len(list_distinct({tok('text')})) / len({tok('text')}) END")}
       AS score
FROM both_texts"""

# ---------------------------------------------------------------- rollouts (C4, RO1-RO13)

GL = repr(0.99 * 0.95)

ROLL = f"""
r_seq AS (SELECT pair_id AS seq_id, {tok('chosen')} AS toks FROM c2),
r_b AS (SELECT seq_id, toks, len(toks) AS n,
               CASE WHEN len(toks) = 0 THEN 0.0 ELSE len(list_distinct(toks)) / len(toks) END AS reward,
               (row_number() OVER (ORDER BY md5(CAST(seq_id AS VARCHAR) || ':42'), seq_id) - 1) // 2 AS batch_id
        FROM r_seq),
r_w AS (SELECT *, max(n) OVER (PARTITION BY batch_id) AS width FROM r_b),
r_p AS (SELECT batch_id, seq_id, reward, n, toks, unnest(range(0, greatest(width - 1, least(width, 1)))) AS pos FROM r_w),
r_t AS (SELECT batch_id, seq_id, reward, pos, pos >= n AS is_pad, CASE WHEN pos < n THEN toks[pos + 1] END AS token
        FROM r_p),
ro AS (SELECT r.batch_id, r.seq_id, r.pos, r.reward,
              CASE WHEN r.is_pad THEN 0.0 ELSE coalesce(c.policy_lp, (SELECT dp FROM c3_d)) END AS policy_lp,
              CASE WHEN r.is_pad THEN 0.0 ELSE coalesce(c.ref_lp, (SELECT dr FROM c3_d)) END AS ref_lp,
              CASE WHEN r.is_pad THEN 0.0 ELSE 1.0 END AS mask,
              CASE WHEN r.is_pad THEN 0.0 ELSE length(r.token) / 10.0 END AS value
       FROM r_t r LEFT JOIN c3 c ON r.token = c.token),
ce AS (SELECT *, reward - avg(CASE WHEN pos = 0 THEN reward END) OVER (PARTITION BY batch_id) AS rc,
              max(pos) OVER (PARTITION BY batch_id) AS last_col FROM ro),
td AS (SELECT *, CASE WHEN pos = last_col THEN rc ELSE 0.0 END AS reward_t FROM ce),
dl AS (SELECT *, reward_t + 0.99 * coalesce(lead(value) OVER (PARTITION BY seq_id ORDER BY pos), 0.0) - value AS delta
       FROM td),
ga AS (SELECT a.seq_id, a.pos, sum(b.delta * pow({GL}, b.pos - a.pos)) AS advantage
       FROM dl a JOIN dl b ON a.seq_id = b.seq_id AND b.pos >= a.pos GROUP BY a.seq_id, a.pos),
fa AS (SELECT d.*, g.advantage, g.advantage + d.value AS returns,
              CASE WHEN d.mask > 0 THEN exp(d.policy_lp - d.ref_lp) ELSE 1.0 END AS ratio
       FROM dl d JOIN ga g ON d.seq_id = g.seq_id AND d.pos = g.pos),
pb AS (SELECT batch_id,
              -avg(least(ratio * advantage, greatest(least(ratio, 1.2), 0.8) * advantage)) AS policy_loss,
              avg(pow(value - returns, 2)) AS value_loss,
              sum((policy_lp - ref_lp) * mask) / nullif(sum(mask), 0) AS kl,
              avg(CASE WHEN pos = 0 THEN rc END) AS reward_mean,
              avg(CASE WHEN pos = 0 THEN reward END) AS raw_reward_mean
       FROM fa GROUP BY batch_id)"""

SQL["center_rewards"] = f"""
WITH {C2}, {C3}, {ROLL}
SELECT CAST(batch_id AS BIGINT) AS batch_id, seq_id, {r6('reward')} AS reward, {r6('rc')} AS reward_centered
FROM ce WHERE pos = 0"""

SQL["td_residuals"] = f"""
WITH {C2}, {C3}, {ROLL}
SELECT CAST(batch_id AS BIGINT) AS batch_id, seq_id, CAST(pos AS BIGINT) AS pos, {r6('mask')} AS mask,
       {r6('value')} AS value, {r6('reward_t')} AS reward_t, {r6('delta')} AS delta FROM dl"""

SQL["gae"] = f"""
WITH {C2}, {C3}, {ROLL}
SELECT CAST(batch_id AS BIGINT) AS batch_id, seq_id, CAST(pos AS BIGINT) AS pos, {r6('advantage')} AS advantage,
       {r6('returns')} AS returns FROM fa"""

SQL["ppo_loss"] = f"""
WITH {C2}, {C3}, {ROLL}
SELECT CAST(batch_id AS BIGINT) AS batch_id, {r6('policy_loss')} AS policy_loss, {r6('value_loss')} AS value_loss,
       {r6('kl')} AS kl, {r6('policy_loss + 0.5 * value_loss + 0.05 * kl')} AS loss FROM pb"""

SQL["rollout_metrics"] = f"""
WITH {C2}, {C3}, {ROLL}
SELECT CAST(batch_id + 1 AS BIGINT) AS step, {r6('policy_loss + 0.5 * value_loss + 0.05 * kl')} AS loss,
       {r6('kl')} AS kl, {r6('reward_mean')} AS reward_mean, {r6('raw_reward_mean')} AS raw_reward_mean,
       CAST((batch_id + 1) % 10 = 0 AS BIGINT) AS logged FROM pb"""

SQL["tree_explode"] = f"""
WITH {C1.split("walk(tree_id")[0].rstrip().rstrip(",")},
t_last AS (SELECT tree_id, CAST(max(CASE WHEN conv_id = root_conv THEN rn END) > 1 AS INTEGER) AS has_rest FROM c1_ranked GROUP BY tree_id),
t_path AS (
  SELECT tree_id, role, text,
         CASE WHEN conv_id = root_conv THEN list_transform(range(1, rn), lambda x: 0)
              ELSE list_prepend(conv_rank - 2 + has_rest, list_transform(range(1, rn), lambda x: 0)) END AS path
  FROM c1_ranked JOIN t_last USING (tree_id))
SELECT tree_id, CAST(len(path) AS BIGINT) AS depth, array_to_string(path, ' ') AS path,
       CASE role WHEN 'prompter' THEN 'user' ELSE role END AS role, text
FROM t_path"""

# ---------------------------------------------------------------- jobs on splits


def split_sql(key: str) -> str:
    return f"CASE WHEN CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 2)) AS INTEGER) < 51 THEN 'test' ELSE 'train' END"


SQL["prepare_rm"] = f"""
WITH {C2}, {VOCAB},
{encoded('ec', 'c2', 'pair_id', 'chosen', 512)},
{encoded('er', 'c2', 'pair_id', 'rejected', 512)},
sp AS (SELECT ec.pair_id, {split_sql('ec.pair_id')} AS split, ec.ids AS c_ids, er.ids AS r_ids
       FROM ec JOIN er ON ec.pair_id = er.pair_id),
b AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY md5(CAST(pair_id AS VARCHAR) || ':42'), pair_id) - 1) // 4
             AS batch_id FROM sp),
m AS (SELECT *, max(greatest(len(c_ids), len(r_ids))) OVER (PARTITION BY split, batch_id) AS width FROM b)
SELECT pair_id, split, CAST(batch_id AS BIGINT) AS batch_id,
       {ids_str('list_resize(c_ids, width, 0)')} AS input_ids_chosen,
       {ids_str('list_resize(list_transform(c_ids, lambda x: 1), width, 0)')} AS attention_mask_chosen,
       {ids_str('list_resize(r_ids, width, 0)')} AS input_ids_rejected,
       {ids_str('list_resize(list_transform(r_ids, lambda x: 1), width, 0)')} AS attention_mask_rejected
FROM m"""

DPO_ROWS = f"""
b AS (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY md5(CAST(pair_id AS VARCHAR) || ':42'), pair_id) - 1) // 2 AS batch_id FROM sp),
m AS (SELECT *, max(len(c_ids)) OVER (PARTITION BY split, batch_id) AS cw, max(len(r_ids)) OVER (PARTITION BY split, batch_id) AS rw FROM b)
SELECT pair_id, split, CAST(batch_id AS BIGINT) AS batch_id, CAST(prompt_len AS BIGINT) AS prompt_len,
       {ids_str('list_resize(c_ids, cw, 0)')} AS chosen_ids, {ids_str('list_resize(r_ids, rw, 0)')} AS rejected_ids,
       CAST(prompt_len >= cw - 1 AS BIGINT) AS chosen_cut, CAST(prompt_len >= rw - 1 AS BIGINT) AS rejected_cut
FROM m"""

SQL["prepare_dpo"] = f"""
WITH {C2}, {VOCAB},
s_in AS (SELECT pair_id, {split_sql('pair_id')} AS split, {prompt_sql('prompt')} || {pair_sql('prompt', 'chosen')} AS c,
                {prompt_sql('prompt')} || {pair_sql('prompt', 'rejected')} AS r,
                len({tok(prompt_sql('prompt'))}) + 1 AS prompt_len
         FROM c2),
{encoded('ec', 's_in', 'pair_id, split, prompt_len', 'c', 511)},
{encoded('er', 's_in', 'pair_id, split, prompt_len', 'r', 511)},
sp AS (SELECT ec.pair_id, ec.split, ec.prompt_len, list_prepend(2, ec.ids) AS c_ids, list_prepend(2, er.ids) AS r_ids
       FROM ec JOIN er ON ec.pair_id = er.pair_id),{DPO_ROWS}"""


def lengths(text: str) -> str:
    return f"[CAST(length(w) + 6 AS INTEGER) FOR w IN list_slice({tok(text)}, 1, 512)]"


SQL["prepare_dpo_encoder"] = f"""
WITH {C2},
sp AS (SELECT pair_id, {split_sql('pair_id')} AS split, len({tok(prompt_sql('prompt'))}) AS prompt_len,
              {lengths(prompt_sql('prompt') + ' || ' + pair_sql('prompt', 'chosen'))} AS c_ids,
              {lengths(prompt_sql('prompt') + ' || ' + pair_sql('prompt', 'rejected'))} AS r_ids
       FROM c2),{DPO_ROWS}"""

TREE_TEXTS = SQL["tree_explode"].split("SELECT tree_id, CAST(len(path)")[0].rstrip()

SQL["prepare_sft"] = f"""{TREE_TEXTS},
{VOCAB},
chat AS (SELECT tree_id, '<|im_start|>system' || {NL} || 'You are a helpful assistant.<|im_end|>' || {NL} ||
                string_agg({block("CASE role WHEN 'prompter' THEN 'user' ELSE role END", 'text')}, {NL} ORDER BY path) || {NL} AS text
         FROM t_path GROUP BY tree_id),
{encoded('enc', 'chat', 'tree_id', 'text', 512)},
b AS (SELECT tree_id, ids, (row_number() OVER (ORDER BY md5(CAST(tree_id AS VARCHAR) || ':42'), tree_id) - 1) // 4 AS batch_id FROM enc),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS width FROM b)
SELECT tree_id, CAST(batch_id AS BIGINT) AS batch_id, {ids_str('list_resize(ids, width, 0)')} AS input_ids,
       {ids_str('list_resize([1 FOR x IN ids], width, 0)')} AS attention_mask,
       {ids_str('[CASE WHEN x = 0 THEN -100 ELSE x END FOR x IN list_resize(ids, width, 0)]')} AS labels
FROM m"""

SQL["prepare_prompts"] = f"""
WITH {VOCAB}, {encoded('en', 'benchmark', 'item_id', 'text', 512)},
e AS (SELECT item_id, ids, CAST(unnest(range(0, 3)) AS BIGINT) AS epoch FROM en),
i AS (SELECT *, (row_number() OVER (PARTITION BY epoch
                   ORDER BY md5(CAST(item_id AS VARCHAR) || ':42:' || CAST(epoch AS VARCHAR)), item_id) - 1) // 2 AS batch_id
      FROM e),
m AS (SELECT *, max(len(ids)) OVER (PARTITION BY epoch, batch_id) AS width FROM i)
SELECT item_id AS prompt_id, epoch, CAST(batch_id AS BIGINT) AS batch_id,
       CAST(epoch * (((SELECT count(*) FROM benchmark) + 1) // 2) + batch_id + 1 AS BIGINT) AS step,
       {ids_str('list_resize(ids, width, 0)')} AS input_ids
FROM m"""

SQL["log_steps"] = f"""
WITH {C2}, {C3}, {ROLL}
SELECT CAST(batch_id + 1 AS BIGINT) AS step, {r6('policy_loss + 0.5 * value_loss + 0.05 * kl')} AS loss
FROM pb WHERE (batch_id + 1) % 10 = 0"""

SQL["simple_advantages"] = f"""
WITH {C2}, {C3}, {ROLL}
SELECT CAST(batch_id AS BIGINT) AS batch_id, seq_id, CAST(pos AS BIGINT) AS pos, {r6('(rc - value) * mask')} AS advantage,
       {r6('rc * mask')} AS returns FROM ce"""

PADDED = f"""
p_b AS (SELECT pair_id, (row_number() OVER (ORDER BY md5(CAST(pair_id AS VARCHAR) || ':42'), pair_id) - 1) // 2 AS batch_id FROM c2),
p_w AS (SELECT t.*, len(toks) AS n, max(len(toks)) OVER (PARTITION BY batch_id, side) AS width
        FROM (SELECT pair_id, side, plen, toks FROM s_t) t JOIN p_b USING (pair_id)),
p_x AS (SELECT pair_id, side, plen, n, width, toks, unnest(range(0, width - 1)) AS pos FROM p_w),
p_t AS (SELECT x.pair_id, x.side, x.plen, x.width, x.pos, x.pos + 1 >= x.n AS is_pad,
               CASE WHEN x.pos + 1 >= x.n THEN -0.5 ELSE coalesce(c.policy_lp, (SELECT dp FROM c3_d)) END AS pl,
               CASE WHEN x.pos + 1 >= x.n THEN -0.25 ELSE coalesce(c.ref_lp, (SELECT dr FROM c3_d)) END AS rl
        FROM p_x x LEFT JOIN c3 c ON c.token = CASE WHEN x.pos + 1 < x.n THEN x.toks[x.pos + 2] END),
p_m AS (SELECT pair_id, side, masked, CAST(plen >= width - 1 AS BIGINT) AS response_cut,
               coalesce(avg(CASE WHEN pos >= plen AND (masked = 0 OR NOT is_pad) THEN pl END), 0.0) AS policy_logp,
               coalesce(avg(CASE WHEN pos >= plen AND (masked = 0 OR NOT is_pad) THEN rl END), 0.0) AS ref_logp
        FROM p_t, (SELECT unnest([0, 1]) AS masked) GROUP BY pair_id, side, masked, plen, width)"""

SQL["padded_logps"] = f"""
WITH {C2}, {C3}, {SEQ}, {PADDED}
SELECT pair_id, CAST(side AS BIGINT) AS side, CAST(masked AS BIGINT) AS masked, {r6('policy_logp')} AS policy_logp,
       {r6('ref_logp')} AS ref_logp, response_cut FROM p_m"""

SQL["evaluate_dpo"] = f"""
WITH {C2}, {C3}, {SEQ}, {PADDED},
q AS (SELECT pair_id, sum(CASE side WHEN 0 THEN policy_logp - ref_logp ELSE ref_logp - policy_logp END) AS m
      FROM p_m WHERE masked = 0 GROUP BY pair_id)
SELECT {split_sql('pair_id')} AS split, {r6('avg(ln(1 + exp(-0.1 * m)))')} AS mean_loss,
       {r6('avg(CASE WHEN m > 0 THEN 0.0 ELSE 1.0 END)')} AS error_rate, count(*) AS n_rows
FROM q GROUP BY 1"""

# ---------------------------------------------------------------- evaluation from logits


def logit_lp(name: str, a: int, b: int) -> str:
    """CTE ``name(pair_id, side, pos, lp)``: log-softmax of the position's whole row of logits at its label."""
    return f"""
{name} AS (SELECT x.pair_id, x.side, x.pos,
    lg[CASE WHEN x.pos + 1 < x.n THEN length(x.toks[x.pos + 2]) % len(lg) ELSE 0 END + 1]
      - (list_max(lg) + ln(list_sum([exp(v - list_max(lg)) FOR v IN lg]))) AS lp
  FROM p_x x JOIN l_e e ON e.e = (x.pair_id + x.pos * {a} + x.side * {b}) % (SELECT count(*) FROM embeddings))"""


LOGIT_MEANS = f"""
l_e AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS e, [CAST(v AS DOUBLE) * 10 FOR v IN embedding] AS lg FROM embeddings),
{logit_lp('l_p', 31, 17)},{logit_lp('l_r', 29, 11)},
l_m AS (SELECT w.pair_id, w.side, masked, max(w.plen >= w.width - 1) AS response_cut,
               coalesce(avg(CASE WHEN x.pos >= w.plen AND (masked = 0 OR x.pos + 1 < w.n) THEN l_p.lp END), 0.0) AS policy_logp,
               coalesce(avg(CASE WHEN x.pos >= w.plen AND (masked = 0 OR x.pos + 1 < w.n) THEN l_r.lp END), 0.0) AS ref_logp
        FROM (SELECT unnest([0, 1]) AS masked), p_w w LEFT JOIN p_x x ON w.pair_id = x.pair_id AND w.side = x.side
        LEFT JOIN l_p ON x.pair_id = l_p.pair_id AND x.side = l_p.side AND x.pos = l_p.pos
        LEFT JOIN l_r ON x.pair_id = l_r.pair_id AND x.side = l_r.side AND x.pos = l_r.pos
        GROUP BY w.pair_id, w.side, masked)"""

SQL["logit_logps"] = f"""
WITH {C2}, {C3}, {SEQ}, {PADDED}, {LOGIT_MEANS}
SELECT pair_id, CAST(side AS BIGINT) AS side, {r6('policy_logp')} AS policy_logp, {r6('ref_logp')} AS ref_logp,
       CAST(response_cut AS BIGINT) AS response_cut FROM l_m WHERE masked = 1"""

SQL["evaluate_dpo_logits"] = f"""
WITH {C2}, {C3}, {SEQ}, {PADDED}, {LOGIT_MEANS},
q AS (SELECT pair_id, sum(CASE side WHEN 0 THEN policy_logp - ref_logp ELSE ref_logp - policy_logp END) AS m
      FROM l_m WHERE masked = 0 GROUP BY pair_id)
SELECT {split_sql('pair_id')} AS split, {r6('avg(ln(1 + exp(-0.1 * m)))')} AS mean_loss, count(*) AS n_rows
FROM q GROUP BY 1"""


def score_sql(text: str) -> str:
    return f"CASE WHEN len({tok(text)}) = 0 THEN 0.0 ELSE 10.0 * len(list_distinct({tok(text)})) / len({tok(text)}) END"


SQL["evaluate_rm"] = f"""
WITH {C2}, s AS (SELECT pair_id, {score_sql('chosen')} - {score_sql('rejected')} AS m FROM c2)
SELECT {split_sql('pair_id')} AS split, {r6('avg(ln(1 + exp(-m)))')} AS mean_loss, count(*) AS n_rows FROM s GROUP BY 1"""

# ---------------------------------------------------------------- permuted epochs


def mixed_sql(source: str, where: str) -> str:
    """``source`` (i, epoch, x) with x mixed once: six half rounds, a subquery each."""
    draw = "CAST('0x' || substr(md5('{r}:' || CAST({half} AS VARCHAR) || ':42:' || CAST(epoch AS VARCHAR)), 1, 8) AS BIGINT)"
    sql = f"(SELECT i, epoch, x // b AS l, x % b AS r, a, b, n FROM {source}, e_size WHERE {where})"
    for r in range(6):
        own, half, side = ("l", "r", "a") if r % 2 == 0 else ("r", "l", "b")
        cols = f"({own} + {draw.format(r=r, half=half)}) % {side} AS {own}, {half}"
        sql = f"(SELECT i, epoch, {cols}, a, b, n FROM {sql})"
    return f"(SELECT i, epoch, CAST(l * b + r AS BIGINT) AS x, n FROM {sql})"


SQL["epoch_batches"] = f"""
WITH RECURSIVE {C2},
e_size AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM c2)),
e_rows AS (SELECT pair_id, row_number() OVER (ORDER BY pair_id) - 1 AS i FROM c2),
e_all AS (SELECT i, CAST(unnest(range(0, 10)) AS BIGINT) AS epoch, i AS x FROM e_rows),
e_walk AS (SELECT i, epoch, x, n FROM {mixed_sql('e_all', 'true')}
           UNION ALL SELECT i, epoch, x, n FROM {mixed_sql('e_walk', 'x >= e_size.n').replace('e_walk, e_size', '(SELECT i, epoch, x FROM e_walk), e_size')})
SELECT pair_id, epoch, x AS idx, x // 2 AS batch_id, CAST(epoch * ((n + 1) // 2) + x // 2 + 1 AS BIGINT) AS step
FROM e_walk JOIN e_rows USING (i) WHERE x < n"""

SQL["tour_preorder"] = f"SELECT tree_id, id, depth, preorder FROM ({SQL['tree_preorder']})"


TEXT_REWARD = ROLL.replace(
    "r_seq AS (SELECT pair_id AS seq_id,", f"r_seq AS (SELECT pair_id AS seq_id, list_slice({tok('prompt || chosen')}, 1, 512) AS scored,").replace(
    "CASE WHEN len(toks) = 0 THEN 0.0 ELSE len(list_distinct(toks)) / len(toks) END AS reward",
    "CASE WHEN len(scored) = 0 THEN 0.0 ELSE len(list_distinct(scored)) / len(scored) END AS reward")

SQL["evaluate_rollouts"] = f"""
WITH {C2}, {C3}, {TEXT_REWARD}
SELECT CAST(batch_id + 1 AS BIGINT) AS step, {r6('policy_loss + 0.5 * value_loss + 0.05 * kl')} AS loss,
       {r6('kl')} AS kl, {r6('reward_mean')} AS reward_mean, {r6('raw_reward_mean')} AS raw_reward_mean FROM pb"""

SQL["gae_long"] = SQL["gae"]

SQL["batch_files"] = SQL["pad_pairs"]

SQL["ordered_texts"] = f"""
SELECT row_number() OVER (ORDER BY conv_id) - 1 AS line, text FROM ({SQL['chatml_conversations']})"""

SQL["nucleus_rows"] = SQL["nucleus"]
SQL["draw_rows"] = SQL["sample_one"]

SQL["tree_files"] = SQL["tree_lines"] = SQL["tree_explode"]

SQL["pair_files"] = f"""
WITH {C2}
SELECT {split_sql('pair_id')} AS split, chosen, rejected, count(*) AS n_rows, count(*) AS n_keys FROM c2 GROUP BY ALL"""

SQL["prompt_files"] = f"""
SELECT {split_sql('item_id')} AS split, text AS prompt, count(*) AS n_rows, count(*) AS n_keys FROM benchmark GROUP BY ALL"""

SQL["token_logps_long"] = SQL["token_logps"]
