"""The same results as DuckDB SQL, written from the definitions and not from the Spark plans:
one row per token, plain window functions, full sorts."""

from __future__ import annotations

from tokenmill import constants as C
from tokenmill.plans import bindings as B

EOT = C.END_OF_TEXT
S, E = C.TURN_START, C.TURN_END
V = C.VOCAB_SIZE


def _bytes(text: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: cast('0x' || x as int))"


def _digest(values: str) -> str:
    return f"md5('[' || array_to_string({values}, ',') || ']')"


def _shuffled(stage: str, row_id: str) -> str:
    return f"md5('{C.SEED}:{stage}:' || cast({row_id} as varchar))"


# ---- common table expressions -------------------------------------------------------

SPLIT = f"""
placed as (
  select doc_id, text, row_number() over (order by doc_id) - 1 as pos, count(*) over () as n_all from documents
), docs as (
  select doc_id, text, pos,
    case when pos < n_all - cast(floor(n_all * {C.CORPUS_VAL_FRACTION}::double) as bigint) then 'train' else 'val' end as split,
    list_append({_bytes('text')}, {EOT}) as tokens
  from placed
)"""

STREAM = f"""{SPLIT}, each as (
  select split, doc_id, unnest(tokens) as tok, unnest(range(len(tokens))) as i from docs
), stream as (
  select split, tok, doc_id, i,
    row_number() over (partition by split order by doc_id, i) - 1 as spot,
    lead(tok) over (partition by split order by doc_id, i) as following,
    count(*) over (partition by split) as n
  from each
), blocks as (
  select split, spot // {B.BLOCK} as block_id, list(tok order by spot) as x, list(following order by spot) as y
  from stream where spot // {B.BLOCK} < (n - 1) // {B.BLOCK} group by 1, 2
)"""

BIGRAMS = f"""
pairs as (
  select coalesce(lag(tok) over (partition by doc_id order by i), {EOT}) as prev, tok as next
  from (select doc_id, unnest(tokens) as tok, unnest(range(len(tokens))) as i from docs where split = 'train')
), counted as (
  select prev, next, count(*) as n from pairs group by 1, 2
), model as (
  select prev, next, n, cast(sum(n) over (partition by prev) as bigint) as n_prev from counted
), scores as (
  select prev, next, n, n_prev, cast(round(ln((n + 1)::double / (n_prev + {V})::double) * 1000000) as bigint) as micro from model
), floors as (
  select prev, cast(round(ln(1.0::double / (any_value(n_prev) + {V})::double) * 1000000) as bigint) as micro from model group by 1
), unseen as (
  select cast(round(ln(1.0::double / {V}::double) * 1000000) as bigint) as micro
)"""

_ROLE = (
    "case role when 'system' then 'system' when 'human' then 'user' when 'user' then 'user' "
    "when 'gpt' then 'assistant' when 'assistant' then 'assistant' end"
)

TURNS = f"""
said as (
  select conv_id, turn, {_ROLE} as role, text from conversations
), turns as (
  select conv_id, turn, role, '{S}' || role || chr(10) || text || '{E}' || chr(10) as shown from said where role is not null
)"""

CHAT = f"""{TURNS}, coded as (
  select conv_id, turn, role, {_bytes('shown')} as tokens from turns
), chat as (
  select conv_id,
    list_append(flatten(list(tokens order by turn)), {EOT}) as tokens,
    list_append(flatten(list(list_transform(tokens, lambda t: (role = 'assistant')::int) order by turn)), 1) as mask
  from coded group by conv_id having bool_or(role = 'assistant')
)"""

SINGLE = f"""
spoken as (
  select conv_id, turn, {_ROLE} as role, coalesce(text, '') as text from conversations
), talk as (
  select conv_id, text as output, role, lag(role) over w as asked_role, lag(text) over w as instruction, lag(turn) over w as asked
  from spoken where role in ('user', 'assistant') window w as (partition by conv_id order by turn)
), systems as (
  select conv_id, arg_min(text, turn) as input from spoken where role = 'system' group by conv_id
), single as (
  select conv_id || ':' || asked as pair_id, instruction, coalesce(input, '') as input, output
  from talk left join systems using (conv_id) where role = 'assistant' and asked_role = 'user'
), asked as (
  select pair_id, instruction, input, output,
    '### Instruction:' || chr(10) || instruction
      || case when trim(input, ' ' || chr(9) || chr(10) || chr(13)) = '' then ''
         else chr(10) || chr(10) || '### Input:' || chr(10) || input end
      || chr(10) || chr(10) || '### Response:' || chr(10) as prompt
  from single
)"""

SIZES = f"""
sizes as (
  select cast(floor((select count(distinct conv_id) from conversations) * {B.SAMPLE_SHARE}::double) as bigint) as cap,
    cast(floor((select count(*) from documents) * {B.SAMPLE_SHARE}::double) as bigint) as head
), sampled as (
  select conv_id, row_number() over (order by {_shuffled('instruction', 'conv_id')}, conv_id) - 1 as rank
  from (select distinct conv_id from conversations)
), kept_conversations as (
  select conv_id, rank from sampled where rank < (select cap from sizes)
), headed as (
  select doc_id, text, row_number() over (order by doc_id) as place from documents
), drawn as (
  select doc_id, text, row_number() over (order by {_shuffled('blend', 'doc_id')}, doc_id) - 1 as rank
  from headed where place <= (select head from sizes)
), blend as (
  select doc_id, text, rank from drawn
  where rank < (select cast(floor(head * {B.SAMPLE_SHARE}::double) as bigint) from sizes)
)"""

BLENDED = f"""blended as (
  select 'corpus:' || cast(doc_id as varchar) as example_id, 'corpus' as source,
    list_append({_bytes('text')}, {EOT}) as tokens,
    list_transform(list_append({_bytes('text')}, {EOT}), lambda t: 1) as mask
  from blend
)"""


def _dataset(instruction: str) -> str:
    return f"""{BLENDED}, united as (
  {instruction} union all select * from blended
), dataset as (
  select example_id, source, tokens, mask,
    case when row_number() over (order by {_shuffled('sft', 'example_id')}, example_id)
      <= greatest(1, cast(floor(count(*) over () * {C.SFT_VAL_FRACTION}::double) as bigint))
    then 'val' else 'train' end as split
  from united
)"""


CHAT_DATASET = f"""{CHAT}, {SIZES}, {_dataset(
    "select 'chat:' || cast(conv_id as varchar) as example_id, 'chat' as source, tokens, mask "
    "from chat where conv_id in (select conv_id from kept_conversations)"
)}"""

SINGLE_CODED = f"""{SINGLE}, single_coded as (
  select pair_id, {_bytes('prompt')} as p, list_append({_bytes('output')}, {EOT}) as r from asked
), single_chat as (
  select pair_id, list_concat(p, r) as tokens,
    list_concat(list_transform(p, lambda t: 0), list_transform(r, lambda t: 1)) as mask
  from single_coded
)"""

SINGLE_DATASET = f"""{SINGLE_CODED}, {SIZES}, {_dataset(
    "select 'single:' || cast(pair_id as varchar) as example_id, 'single' as source, tokens, mask from single_chat"
)}"""

SUMMARY = """select example_id, source, split, cast(len(tokens) as bigint) as n_tokens,
  cast(list_sum(mask) as bigint) as n_trainable from dataset"""

TENSORS = f"""{CHAT}, cut as (
  select conv_id, w * {B.SFT_BLOCK} as start, tokens[w * {B.SFT_BLOCK} + 1:(w + 1) * {B.SFT_BLOCK} + 1] as t,
    mask[w * {B.SFT_BLOCK} + 1:(w + 1) * {B.SFT_BLOCK} + 1] as k
  from chat, range(greatest((len(tokens) + {B.SFT_BLOCK} - 2) // {B.SFT_BLOCK}, 1)) as r(w)
), tensors as (
  select conv_id, start,
    list_transform(range({B.SFT_BLOCK}), lambda i: case when i + 1 < len(t) then t[i + 1] else {C.PAD_TOKEN} end) as x,
    list_transform(range({B.SFT_BLOCK}), lambda i: case when i + 1 < len(t) then t[i + 2] else {C.IGNORE_INDEX} end) as y,
    list_transform(range({B.SFT_BLOCK}), lambda i: case when i + 1 < len(t) then k[i + 1] else 0 end) as m,
    list_transform(range({B.SFT_BLOCK}), lambda i: case when i + 1 < len(t) then k[i + 2] else 0 end) as m_target
  from cut
), targets as (
  select conv_id, start, x, 'input' as align,
    list_transform(range({B.SFT_BLOCK}), lambda i: case when m[i + 1] = 0 then {C.IGNORE_INDEX} else y[i + 1] end) as y from tensors
  union all
  select conv_id, start, x, 'target' as align,
    list_transform(range({B.SFT_BLOCK}), lambda i: case when m_target[i + 1] = 0 then {C.IGNORE_INDEX} else y[i + 1] end) from tensors
)"""

ITEMS = """
words as (
  select item_id, string_split(text, ' ') as w, (select count(*) from benchmark) as n from benchmark
), parts as (
  select item_id, n, array_to_string(w[1:len(w) - 3], ' ') as ctx, array_to_string(w[len(w) - 2:len(w)], ' ') as ending from words
), choices as (
  select p.item_id, cast(j as int) as choice_idx, p.ctx as context, ' ' || e.ending as continuation,
    cast(p.item_id % 4 as int) as label
  from parts p cross join (select unnest(range(4)) as j)
  join parts e on e.item_id = (p.item_id + (j - p.item_id % 4 + 4) % 4) % p.n
)"""

CLOZES = """
cut as (
  select item_id, string_split(text, ' ') as w, len(string_split(text, ' ')) // 2 as mid,
    (select count(*) from benchmark) as n from benchmark
), middles as (
  select item_id, n, w[mid + 1] as word,
    array_to_string(w[1:mid], ' ') || ' ' as before, ' ' || array_to_string(w[mid + 2:len(w)], ' ') as after from cut
), clozes as (
  select m.item_id, cast(j as int) as choice_idx, m.before as context,
    case when (m.item_id + j) % 2 = 0 then m.word else o.word end || m.after as continuation,
    case when m.item_id % 2 = 0 then '1' else '2' end as answer
  from middles m join middles o on o.item_id = (m.item_id + 1) % m.n cross join (select unnest(range(2)) as j)
)"""

LAST_WORDS = """
lastwords as (
  select item_id, array_to_string(w[1:len(w) - 1], ' ') as context, ' ' || w[len(w)] as continuation
  from (select item_id, string_split(text, ' ') as w from benchmark) where len(w) > 1
)"""


def _scored(requests: str, name: str) -> str:
    """Scores of a request table: one row per continuation token, looked up one by one."""
    return f"""
{name}_coded as (
  select *, {_bytes('context')} as c, {_bytes('continuation')} as k from {requests}
), {name}_cut as (
  select * exclude (c, k), list_concat(c, k) as t, len(k) as n_k from {name}_coded
), {name}_tokens as (
  select item_id, choice_idx, t[i + 1] as next, case when i = 0 then {EOT} else t[i] end as prev
  from (select *, unnest(range(len(t) - n_k, len(t))) as i from {name}_cut)
), {name} as (
  select r.*, coalesce(s.score, 0) as score from {requests} r left join (
    select item_id, choice_idx,
      cast(sum(coalesce(m.micro, f.micro, (select micro from unseen))) as bigint) / 1000000 as score
    from {name}_tokens q left join scores m using (prev, next) left join floors f using (prev)
    group by 1, 2
  ) s using (item_id, choice_idx)
)"""


CHOICE_PICKS = """
choice_picks as (
  select item_id, (choice_idx = label)::int as hit from (
    select *, row_number() over (partition by item_id order by score desc, choice_idx) as place from scored_choices
  ) where place = 1
)"""

CLOZE_PICKS = """
cloze_picks as (
  select item_id, ((case when max(score) filter (where choice_idx = 0) > max(score) filter (where choice_idx = 1)
    then '1' else '2' end) = any_value(answer))::int as hit
  from scored_clozes group by item_id
)"""

def _last_word_picks() -> str:
    """The likeliest piece behind the context's last one, counted over the training documents."""
    return f"""
train_pieces as (
  select doc_id, unnest(list_append(p, '{C.END_OF_TEXT_PIECE}')) as piece, unnest(range(len(p) + 1)) as i
  from (select doc_id, {_presplit()} as p from docs where split = 'train')
), piece_pairs as (
  select coalesce(lag(piece) over (partition by doc_id order by i), '{C.END_OF_TEXT_PIECE}') as prev, piece as next from train_pieces
), best_next as (
  select prev, next from (
    select prev, next, row_number() over (partition by prev order by count(*) desc, next) as place from piece_pairs group by prev, next
  ) where place = 1
), lastword_picks as (
  select item_id, coalesce((b.next = wanted)::int, 0) as hit from (
    select item_id, coalesce({_presplit('context')}[-1], '{C.END_OF_TEXT_PIECE}') as prev, {_presplit('continuation')}[1] as wanted
    from lastwords
  ) left join best_next b using (prev)
)"""


def _accuracy(picks: str, task: str) -> str:
    return (
        f"select '{task}' as task, count(*) as n, cast(coalesce(sum(hit), 0) as bigint) as correct, "
        f"coalesce(sum(hit)::double / nullif(count(*), 0), 0.0::double) as acc from {picks}"
    )


_METRIC = "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in B.METRICS.items()) + " end"

LOG = f"""
log as (
  select user_id as run, event_id as step, {_METRIC} as metric, value, ts as logged_at from events
)"""

RESUMED = f"""{LOG}, resumed as (
  select run, step // 1000 as step, metric, arg_max(value, {{'at': logged_at, 'value': value}}) as value from log group by 1, 2, 3
)"""

LATEST = f"""{LOG}, latest as (
  select run, metric, step, value from (
    select *, row_number() over (partition by run, metric order by step desc, logged_at desc) as place from log
  ) where place = 1
)"""

_LABELS = {
    "eval/hellaswag_acc": "Hellaswag",
    "eval/lambada_acc": "Lambada",
    "eval/arc_easy_acc": "Arc Easy",
    "eval/winogrande_acc": "Winogrande",
    "eval/val_loss": "Val Loss",
}
_LABEL = "case metric " + " ".join(f"when '{k}' then '{v}'" for k, v in _LABELS.items()) + " end"
_TEXT = "case when metric like '%acc%' then printf('%.2f%%', value * 100) else printf('%.4f', value) end"

FILES = """
files as (
  select printf('ckpt_%07d.pt', event_id * 500) as path, event_id * 500 as iter, event_type from events
), waiting as (
  select path, iter from files
  where iter % 5000 = 0 and iter <> 0 and path not in (select path from files where event_type = 'view')
)"""


def _presplit(text: str = "text") -> str:
    """Pieces without a look-ahead: first mark where a run of blanks gives up its last blank."""
    marked = f"regexp_replace({text}, '(\\s+)(\\s\\S)', '\\1' || chr(57344) || '\\2', 'g')"
    pattern = "''(?:[sdmt]|ll|ve|re)| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}\\x{E000}]+|\\s+"
    return f"regexp_extract_all({marked}, '{pattern}')"


def _bpe() -> str:
    """Merges in rank order on hex-coded pieces; '<..>' is a token, '|' a piece border."""
    known = {bytes([b]) for b in range(256)}
    spelled = f"array_to_string(list_transform({_presplit()}, lambda p: regexp_replace(lower(hex(encode(p))), '(..)', '<\\1>', 'g')), '|')"
    cases = []
    for rank, merge in enumerate(B.MERGES, 256):
        token = merge.encode()
        for cut in range(1, len(token)):
            left, right = token[:cut], token[cut:]
            if left in known and right in known:
                spelled = f"replace({spelled}, '<{left.hex()}><{right.hex()}>', '<{token.hex()}>')"
        known.add(token)
        cases.append(f"when '{token.hex()}' then {rank}")
    ids = f"list_transform(regexp_extract_all(spelled, '<([0-9a-f]+)>', 1), lambda h: case h {' '.join(cases)} else cast('0x' || h as int) end)"
    return f"""with spelled as (select doc_id, {spelled} as spelled from documents),
coded as (select doc_id, list_append({ids}, {EOT}) as tokens from spelled)
select doc_id, cast(len(tokens) as int) as n_tokens, {_digest('tokens')} as tok_md5 from coded"""


_TOKENIZED = f"""select doc_id, cast(len(tokens) as int) as n_tokens, {_digest('tokens')} as tok_md5
from (select doc_id, list_append({_bytes('text')}, {EOT}) as tokens from documents)"""

_BLOCKS = f"with {STREAM} select split, block_id, {_digest('x')} as x_md5, {_digest('y')} as y_md5 from blocks"

# the whole corpus as one stream
_ONE_STREAM = f"""with {STREAM.replace("else 'val' end", "else 'train' end")}
select block_id, {_digest('x')} as x_md5, {_digest('y')} as y_md5 from blocks"""

_FLOOR = C.SCALING_E + C.SCALING_A / C.SCALING_PARAMETERS**C.SCALING_ALPHA
_PERCENT = "case when {0} is null then 'TBD' else printf('%.2f%%', {0}) end"

_PARSED = f"""with {LOG}, firsts as (
  select run, metric, arg_min(value, step) as value from log group by 1, 2
), wanted as (
  select run as log, name as metric, 'eval/' || name || case name when 'val_loss' then '' else '_acc' end as metric_key
  from (select distinct run from log) cross join (select unnest({list(C.LOG_PATTERNS)!r}) as name)
) select log, w.metric, cast(case when f.metric like '%acc' then printf('%.2f', f.value * 100) else printf('%.4f', f.value) end as double) as value
from wanted w left join firsts f on f.run = w.log and f.metric = w.metric_key"""

_SCORES = f"""with {SPLIT}, {BIGRAMS}, {ITEMS}, {_scored('choices', 'scored_choices')}
select item_id, choice_idx, score from scored_choices"""

_FLAGGED = f"""with {RESUMED}, past as (
  select *, min(case when step % {B.EVAL_EVERY} = 0 then value end) over (
    partition by run, metric order by step rows between unbounded preceding and 1 preceding) as lowest from resumed
), marked as (
  select *, step % {B.EVAL_EVERY} = 0 and (lowest is null or value < lowest) as is_best from past
) select run, metric, step, value, is_best, is_best or (step % {C.SAVE_EVERY} = 0 and step > 0) as is_saved from marked"""

ORACLES: dict[str, str] = {
    # ---- corpus
    "corpus_stats": f"""with {SPLIT}, sized as (
  select split, octet_length(encode(text)) + 1 as n from docs
) select split, count(*) as n_docs, cast(sum(n) as bigint) as n_tokens, cast(sum(n) * 2 as bigint) as n_bytes from sized group by split""",
    "corpus_split": f"with {SPLIT} select doc_id, pos, split from docs",
    "tokenize_bytes": _TOKENIZED,
    "tokenize_pieces": f"""select doc_id, cast(len(p) as int) as n_pieces, md5(array_to_string(p, '|')) as pieces_md5
from (select doc_id, {_presplit()} as p from documents)""",
    "tokenize_bpe": _bpe(),
    "token_store": f"""with {SPLIT} select doc_id, split, len(tokens) as n_tokens, {_digest('tokens')} as tok_md5,
  cast(sum(len(tokens)) over (partition by split order by doc_id) - len(tokens) as bigint) as tok_start from docs""",
    "pack_blocks": _BLOCKS,
    "packed_export": _BLOCKS,
    # ---- instruction data
    "alpaca_format": f"with {SINGLE} select pair_id, prompt, output as response from asked",
    "alpaca_tokens": f"""with {SINGLE_CODED} select pair_id, cast(len(tokens) as int) as n_tokens,
  cast(list_sum(mask) as int) as n_trainable, {_digest('tokens')} as tok_md5, {_digest('mask')} as mask_md5 from single_chat""",
    "chatml_render": f"""with {TURNS} select conv_id, 0::bigint as start, cast(count(*) as int) as n_turns,
  md5(string_agg(shown, '' order by turn)) as text_md5 from turns group by conv_id""",
    "chatml_tokens": f"""with {CHAT} select conv_id, 0::bigint as start, cast(len(tokens) as int) as n_tokens,
  cast(list_sum(mask) as int) as n_trainable, {_digest('tokens')} as tok_md5, {_digest('mask')} as mask_md5 from chat""",
    "sft_skipped": """with per as (select conv_id, bool_or(role in ('assistant', 'gpt')) as kept from conversations group by 1)
select count(*) filter (where kept) as n_kept, count(*) filter (where not kept) as n_skipped from per""",
    "chat_prompt": f"""with {SINGLE} select pair_id,
  '{S}system' || chr(10) || '{C.DEFAULT_SYSTEM}{E}' || chr(10) || '{S}user' || chr(10)
  || case when trim(input, ' ' || chr(9) || chr(10) || chr(13)) = '' then instruction
     else trim(instruction || chr(10) || chr(10) || input, ' ' || chr(9) || chr(10) || chr(13)) end
  || '{E}' || chr(10) || '{S}assistant' || chr(10) as prompt from asked""",
    "trim_completion": """select conv_id, turn,
  trim(substr(text, 1, length(text) // 2), ' ' || chr(9) || chr(10) || chr(13)) as text from conversations""",
    "instruction_sample": f"with {SIZES} select conv_id, rank from kept_conversations",
    "blend_sample": f"with {SIZES} select doc_id, rank from blend",
    "sft_dataset": f"with {CHAT_DATASET} {SUMMARY}",
    "sft_dataset_single_turn": f"with {SINGLE_DATASET} {SUMMARY}",
    "sft_jsonl_roundtrip": f"""with {CHAT_DATASET} select split, count(*) as n, cast(sum(len(tokens)) as bigint) as n_tokens,
  cast(sum(list_sum(tokens)) as bigint) as tokens_sum, cast(sum(list_sum(mask)) as bigint) as mask_sum from dataset group by split""",
    "sft_tensors": f"""with {TENSORS} select conv_id, {_digest('x')} as x_md5, {_digest('y')} as y_md5, {_digest('m')} as m_md5 from tensors where start = 0""",
    "sft_targets": f"""with {TENSORS} select conv_id, start::bigint as start, align,
  cast(len(list_filter(y, lambda t: t <> {C.IGNORE_INDEX})) as int) as n_targets, {_digest('y')} as y_md5 from targets""",
    "batch_plan": f"""with {SPLIT}, plan as (
  select (cast(sum(len(tokens)) as bigint) - 1) // {B.BLOCK} as n from docs where split = 'train'
), ids as (select unnest(range(n)) as block_id, n from plan
), drawn as (
  select cast(e as int) as epoch, block_id, n,
    row_number() over (partition by e order by {_shuffled("epoch", "e || ':' || block_id")}) - 1 as pos
  from ids cross join (select unnest(range({B.EPOCHS})) as e)
), batches as (
  select *, epoch * ((n + {C.BATCH_SIZE - 1}) // {C.BATCH_SIZE}) + pos // {C.BATCH_SIZE} as batch from drawn
) select epoch, batch // {C.ACCUMULATION_STEPS} as step, cast(batch % {C.ACCUMULATION_STEPS} as int) as micro_step,
  cast(pos % {C.BATCH_SIZE} as int) as slot, block_id from batches""",
    "data_budget": f"""with {CHAT_DATASET} select count(*) as rows, cast(sum(len(tokens)) as bigint) as tokens,
  {C.TOKENS_PER_STEP}::bigint as tokens_per_step,
  round({C.SFT_STEPS * C.EXAMPLES_PER_STEP}::double / count(*), 6) as epochs from dataset where split = 'train'""",
    # ---- evaluation
    "mc_requests": f"with {ITEMS} select item_id, choice_idx, context, continuation, label from choices",
    "labelled_requests": f"""with {ITEMS} select item_id, choice_idx, context, continuation,
  chr(65 + choice_idx) as choice_label, chr(65 + label) as answer_key from choices""",
    "cloze_requests": f"with {CLOZES} select item_id, choice_idx, context, continuation, answer from clozes",
    "lastword_requests": f"""with {LAST_WORDS} select item_id, context, continuation,
  {_digest(_bytes('context') + f'[-{B.REQUEST_BLOCK - 1}:]')} as context_md5 from lastwords""",
    "loglik_requests": f"""with {ITEMS}, coded as (
  select item_id, choice_idx, octet_length(encode(continuation)) as k,
    list_concat(list_filter({_bytes('context')}, lambda b, i:
      i > octet_length(encode(context)) + octet_length(encode(continuation)) - {B.REQUEST_BLOCK}), {_bytes('continuation')}) as t
  from choices
) select item_id, choice_idx, cast(len(t) as int) as n_tokens, cast(len(t) - k as int) as cont_start,
  {_digest('t')} as tok_md5 from coded""",
    "bigram_model": f"with {SPLIT}, {BIGRAMS} select prev, next, n, micro / 1000000 as logprob from scores",
    "loglik_scores": _SCORES,
    "loglik_callback": _SCORES,
    "mc_accuracy": f"""with {SPLIT}, {BIGRAMS}, {ITEMS}, {_scored('choices', 'scored_choices')}, {CHOICE_PICKS}
{_accuracy('choice_picks', 'choice')} union all {_accuracy('choice_picks', 'labelled')}""",
    "cloze_accuracy": f"""with {SPLIT}, {BIGRAMS}, {CLOZES}, {_scored('clozes', 'scored_clozes')}, {CLOZE_PICKS}
{_accuracy('cloze_picks', 'cloze')}""",
    "lastword_accuracy": f"""with {SPLIT}, {BIGRAMS}, {LAST_WORDS}, {_last_word_picks()} {_accuracy('lastword_picks', 'lastword')}""",
    "running_accuracy": f"""with {SPLIT}, {BIGRAMS}, {ITEMS}, {_scored('choices', 'scored_choices')}, {CHOICE_PICKS},
{CLOZES}, {_scored('clozes', 'scored_clozes')}, {CLOZE_PICKS}, {LAST_WORDS}, {_last_word_picks()}, hits as (
  select 'choice' as task, * from choice_picks union all select 'cloze', * from cloze_picks
  union all select 'lastword', * from lastword_picks
), numbered as (
  select task, row_number() over w as n, avg(hit) over w as acc from hits
  window w as (partition by task order by item_id rows unbounded preceding)
) select task, n, acc from numbered where n % {B.RUNNING_EVERY} = 0""",
    "masked_loss": f"""with {SPLIT}, {BIGRAMS}, {CHAT}, looked as (
  select conv_id, unnest(tokens[1:len(tokens) - 1]) as prev, unnest(tokens[2:]) as next, unnest(mask[1:len(mask) - 1]) as counts from chat
) select q.conv_id, -cast(sum(coalesce(m.micro, f.micro, (select micro from unseen))) filter (counts = 1) as bigint)
    / nullif(count(*) filter (counts = 1), 0) / 1000000 as loss
from looked q left join scores m using (prev, next) left join floors f using (prev) group by q.conv_id""",
    "val_loss": f"""with {STREAM}, {BIGRAMS}, looked as (
  select block_id // {C.BATCH_SIZE} as batch, unnest(x) as prev, unnest(y) as next from blocks where split = 'val'
), batches as (
  select batch, cast(sum(coalesce(m.micro, f.micro, (select micro from unseen))) as bigint) as total, count(*) as n
  from looked q left join scores m using (prev, next) left join floors f using (prev)
  group by batch
) select cast(sum(cast(round(-total / n) as bigint)) as bigint) / count(*) / 1000000 as mean_of_means,
  -cast(sum(total) as bigint) / cast(sum(n) as bigint) / 1000000 as token_mean,
  round(exp(-cast(sum(total) as bigint) / cast(sum(n) as bigint) / 1000000), 6) as perplexity from batches""",
    "sft_val_loss": f"""with {SPLIT.replace('docs as', 'split_docs as')}, {BIGRAMS.replace('from docs', 'from split_docs')}, {CHAT_DATASET},
windows as (
  select d.*, w, {_shuffled('sft', 'example_id')} as key
  from dataset d, range(greatest((len(tokens) + {B.SFT_BLOCK} - 2) // {B.SFT_BLOCK}, 1)) as r(w) where split = 'val'
), ordered as (
  select *, row_number() over (order by key, example_id, w) - 1 as rank from windows
), looked as (
  select rank // {C.BATCH_SIZE} as batch, unnest(tokens[w * {B.SFT_BLOCK} + 1:least((w + 1) * {B.SFT_BLOCK}, len(tokens) - 1)]) as prev,
    unnest(tokens[w * {B.SFT_BLOCK} + 2:(w + 1) * {B.SFT_BLOCK} + 1]) as next,
    unnest(mask[w * {B.SFT_BLOCK} + 1:least((w + 1) * {B.SFT_BLOCK}, len(tokens) - 1)]) as counts from ordered
), batches as (
  select batch, cast(sum(coalesce(m.micro, f.micro, (select micro from unseen))) as bigint) as total, count(*) as n
  from looked q left join scores m using (prev, next) left join floors f using (prev)
  where counts = 1 group by batch
) select cast(sum(cast(round(-total / n) as bigint)) as bigint) / count(*) / 1000000 as mean_of_means,
  -cast(sum(total) as bigint) / cast(sum(n) as bigint) / 1000000 as token_mean,
  round(exp(-cast(sum(total) as bigint) / cast(sum(n) as bigint) / 1000000), 6) as perplexity from batches""",
    "nucleus_candidates": f"""with {SPLIT}, {BIGRAMS}, ranked as (
  select prev, next, n + 1 as w, 1 as n_tokens, rank() over (partition by prev order by n desc) as place,
    count(*) over (partition by prev) as seen from scores
), best as (
  select prev, next, w, n_tokens from ranked where place <= {B.TOP_K}
  union all
  select prev, null, 1, {V} - any_value(seen) from ranked group by prev having any_value(seen) < {B.TOP_K}
), massed as (
  select prev, next, w, n_tokens,
    sum(w * n_tokens) over (partition by prev order by w desc, next nulls last rows unbounded preceding) - w * n_tokens as before,
    sum(w * n_tokens) over (partition by prev) as everything from best
), kept as (
  select prev, next, w, least(n_tokens, cast(floor(({B.TOP_P}::double * everything::double - before::double) / w) as bigint) + 1)::bigint as n_tokens
  from massed
) select prev, next, n_tokens, w::double / cast(sum(w * n_tokens) over (partition by prev) as double) as p from kept where n_tokens > 0""",
    # ---- metrics
    "metric_resolved": f"with {RESUMED} select run, step, metric, value from resumed",
    "metric_append": f"with {RESUMED} select run, step, metric, value from resumed",
    "metric_snapshot": f"with {RESUMED} select run, step, metric, value from resumed",
    "metric_latest": f"with {LATEST} select run, metric, step, value from latest",
    "metric_wide": f"with {LATEST} select run, "
    + ", ".join(f"max(value) filter (where metric = '{m}') as {m.removeprefix('eval/')}" for m in B.METRICS.values())
    + " from latest group by run",
    "metric_report": f"with {LATEST} select run, {_LABEL} as label, {_TEXT} as text from latest",
    "best_checkpoints": _FLAGGED,
    "throughput": f"""with {LOG}, steps as (
  select run, step // 1000 as step, max(logged_at) as logged_at from log group by 1, 2
), past as (
  select *, lag(step) over w as s0, lag(logged_at) over w as t0 from steps window w as (partition by run order by step)
) select run, step, round(((step - s0) * {C.TOKENS_PER_STEP})::double / nullif((epoch_us(logged_at) - epoch_us(t0)) / 1000000, 0), 4) as tokens_per_sec
from past""",
    "scaling_gap": f"""with {LOG}, predicted as (
  select *, (step * {C.TOKENS_PER_STEP})::double as d,
    {_FLOOR!r}::double + {C.SCALING_B}::double / pow((step * {C.TOKENS_PER_STEP})::double, {C.SCALING_BETA}::double) as p
  from log where metric = 'eval/val_loss' and step > 0
) select run, step, round(d / 1e9, 6) as tokens_b, value as actual, round(p, 4) as predicted, round(value - p, 4) as gap from predicted""",
    "pending_checkpoints": f"with {FILES} select path, iter from waiting",
    "next_checkpoint": f"with {FILES} select path, iter from waiting order by iter limit 1",
    "parse_eval_log": _PARSED,
    "eval_log_roundtrip": _PARSED,
    "version_compare": f"""with {LATEST}, joined as (
  select coalesce(a.pair, b.pair) as pair, coalesce(a.metric, b.metric) as metric, a.value as v1, b.value as v2
  from (select run // 2 as pair, metric, value from latest where run % 2 = 0) a
  full join (select run // 2 as pair, metric, value from latest where run % 2 = 1) b
    on a.pair = b.pair and a.metric = b.metric
) select pair, metric, v1, v2, round(v2 - v1, 6) as delta,
  {_PERCENT.format('v1')} || ' | ' || {_PERCENT.format('v2')} || ' | ' ||
  case when v1 is null or v2 is null then 'TBD' else case when v2 > v1 then '+' else '' end || printf('%.2f%%', v2 - v1) end as text
from joined""",
    "mapped_turns": """select conv_id, turn, upper(role) as role, (place - 1)::integer as place, part as sentence
from (select conv_id, turn, role, unnest(string_split(text, '.')) as raw, generate_subscripts(string_split(text, '.'), 1) as place
  from conversations where trim(coalesce(text, ''), ' ') <> ''), lateral (select trim(raw, ' ') as part) where part <> ''""",
    "checkpoint_listing": """select printf('ckpt_%07d.pt', s_suppkey * 500) as file, (s_suppkey * 500)::bigint as iter from supplier""",
    # ---- streams
    "stream_checkpoint_files": """select printf('ckpt_%07d.pt', s_suppkey * 500) as file, (s_suppkey * 500)::bigint as iter
from supplier where (s_suppkey * 500) % 5000 = 0 and s_suppkey <> 0""",
    "stream_corpus_tokens": _TOKENIZED,
    "stream_checkpoint_pickup": """select printf('ckpt_%07d.pt', event_id * 500) as path, event_id * 500 as iter
from events where (event_id * 500) % 5000 = 0 and event_id <> 0""",
    "stream_pack_blocks": _ONE_STREAM,
    "stream_best_flags": _FLAGGED,
    "stream_best_metric": f"""with {LOG} select run, metric, arg_min(step, struct_pack(v := value, s := step)) as step,
  min(value) as value from log group by 1, 2""",
}
