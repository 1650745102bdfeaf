"""Problem 2: broken prompt and response pairs, and tool calls and results that do not belong together.

Sessions are read as Arrow batches and walked once; nothing is shuffled but the answers' cut-off counts.
A copy of the question is found by compressing the answer with the question as a zstandard dictionary: an
answer that the dictionary nearly explains, and whose letters the question nearly covers, is an echo.
Refusals and languages come from dictionaries, cut answers from the closing-word terminality of
``tracewright.llm.truncation``, counted over all answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.neardup import both_session_tables
from tracewright.llm.textkit import language, visible
from tracewright.llm.truncation import cut_texts
from tracewright.session import durable

#: What a refusing sentence says, by language.  Such a sentence names no code.
REFUSALS = [
    r"\b(?:can'?t|can ?not|unable to|not able to|won'?t be able to|not in a position to)\b.{0,25}\b(?:help|assist|answer|provide|comply|discuss|do (?:this|that|so)|work on|respond|support|fulfil|complete|share|engage|continue)",
    r"\b(?:must|have to|need to|going to|want to|will|i)\b.{0,20}\b(?:decline|refuse|pass on)\b",
    r"\brather not\b|\bnot (?:something i'?m |be )?(?:comfortable|permitted|allowed|authori[sz]ed|willing)\b|\bisn'?t something i'?m comfortable\b|\bnot comfortable\b",
    r"\bpolic(?:y|ies) (?:does|do|did)(?: not|n'?t) (?:allow|permit)|\bagainst (?:my|our|the) (?:guidelines|polic|rules|principles)|\b(?:instructions|guidelines|rules|polic\w+) (?:prevent|forbid|prohibit)|\brequest (?:is |was )?(?:denied|refused)|\bwhat i'?m (?:permitted|allowed)|\boutside (?:what|of what) i\b",
    r"\bwon'?t be (?:doing|helping|answering)\b|\bi (?:won'?t|will not|shall not) (?:do|help|answer|assist|discuss)\b|^sorry,? no\b|^no,? (?:thanks|sorry)\b|\bas an ai\b.{0,40}\b(?:can'?t|cannot|not|unable)\b",
    r"\b(?:kann|darf|möchte|will|werde)\b.{0,60}\b(?:nicht|keine?n?)\b.{0,40}\b(?:helfen|beantworten|antworten|unterstützen|behilflich|besprechen|bearbeiten|erfüllen|weiterhelfen)",
    r"\b(?:muss|möchte|werde)\b.{0,50}\b(?:ablehnen|verweigern)|\blehne\b.{0,50}\bab\b|\bals (?:sprachmodell|ki)\b.{0,40}\b(?:nicht|kein)|\bnicht (?:erlaubt|gestattet|befugt)\b|\banfrage abgelehnt\b",
    r"\bno (?:puedo|podré|debo|voy a|me es posible)\b.{0,30}\b(?:ayud|respond|contest|hac|asist|coment|proporcion|continu|atend)|\b(?:debo|tengo que|prefiero) (?:rechazar|negarme|declinar|no)\b|\bno (?:me )?est(?:á|oy) (?:permitid|autorizad)|\bno me está permitid|\bme niego\b|\bcomo (?:modelo de lenguaje|ia)\b.{0,40}\bno\b|\bsolicitud (?:denegada|rechazada)\b",
    r"\bne (?:peux|puis|pourrai) pas\b.{0,40}\b(?:aider|répondre|assister|faire|fournir|discuter|continuer|traiter)|\b(?:dois|préfère|souhaite) (?:décliner|refuser)|\bje (?:refuse|décline)\b|\bpas (?:le droit|autorisé|permis)\b|\ben tant que (?:modèle|ia)\b.{0,40}\b(?:ne|pas)\b|\bdemande refusée\b|\bimpossible de (?:vous aider|répondre)\b",
    r"(?:无法|不能|不可以|不便|没法|不会).{0,6}(?:协助|回答|帮|完成|提供|讨论|处理|满足|继续)|拒绝(?:回答|这个|该|此)?|作为(?:一个)?(?:语言模型|人工智能|AI).{0,12}(?:不|无)|不被允许|不允许我|必须拒绝",
]
#: What may stand around a refusal without being an answer.
FILLERS = [
    r"^(?:i (?:see|understand|know|realise|realize|appreciate)|thank(?:s| you)|okay|ok|hi|hello|hey|sorry|i'?m sorry|i apologi[sz]e|my apologies|unfortunately|well)\b",
    r"^(?:let me know|is there (?:something|anything) else|please (?:ask|contact|consult|try|rephrase|reach out|let)|feel free|perhaps|maybe|i (?:can|could|would|will)\b.{0,25}\b(?:another|something else|other))|\bcould break (?:the )?rules\b|\bother topics?\b|\banother topic\b|\b(?:it|this|that) (?:could|may|might|would) (?:be|cause|break|violate)\b",
    r"^(?:danke|vielen dank|gern|gerne|bitte wende|bitte frag|ich (?:verstehe|sehe)|tut mir leid|leider|entschuldigung)\b|\bander(?:en|es|em) thema\b",
    r"^(?:gracias|lo siento|entiendo|veo que|por favor|disculp|perdón)\b|\botro tema\b|\botra cosa\b",
    r"^(?:merci|désolé|je (?:vois|comprends)|veuillez|n'hésitez|pardon)\b|\bautre sujet\b|\bautre chose\b",
    r"^(?:抱歉|对不起|很抱歉|不好意思|谢谢|感谢|我理解|我明白)|换一个话题|其他(?:问题|话题)|别的(?:问题|话题)",
]
_REFUSAL = regex.compile("|".join(f"(?:{p})" for p in REFUSALS), regex.I)
_FILLER = regex.compile("|".join(f"(?:{p})" for p in FILLERS), regex.I)
_CODE = regex.compile(r"`|[\w]_[\w]|\w/\w|\p{Ll}\p{Lu}\p{Ll}|\d")
_SENTENCE = regex.compile(r"[^.!?。！？;；\n]+(?:\.(?=\w)[^.!?。！？;；\n]*)*[.!?。！？;；]*")
#: Names of languages with which a question may ask for one.
_ASKS = regex.compile(
    r"\b(?:in|into|to|auf|ins|en|al|à|vers)\s+(?:the\s+|la\s+|le\s+)?(?:english|german|french|spanish|chinese|mandarin|englisch\w*|deutsch\w*|französisch\w*|spanisch\w*|chinesisch\w*|inglés|alemán|francés|español|chino|anglais|allemand|français|espagnol|chinois)\b|(?:用|以|成|译成)\s*(?:中文|汉语|英文|英语|德语|德文|法语|法文|西班牙语)|\btranslat|\bübersetz|\btraduc|\btradui|翻译",
    regex.I,
)
#: What zstandard needs for a block that the dictionary explains wholly, and for an empty frame.
BLOCK, FRAME = 6, 9


def is_refusal(answer: str) -> bool:
    """Every sentence refuses or is filler, and at least one refuses; texts of any length."""
    refused = False
    for found in _SENTENCE.finditer(answer.replace("’", "'")):
        sentence = found[0].strip()
        if not sentence or not any(c.isalnum() for c in sentence):
            continue
        if _REFUSAL.search(sentence) and not _CODE.search(sentence):
            refused = True
        elif not _FILLER.search(sentence):
            return False
    return refused


def _plain(text: str) -> str:
    return " ".join(text.casefold().split())


def is_echo(question: str, answer: str, explained: float = 0.6, covered: float = 0.7) -> bool:
    """Whether the answer is the question again, at most framed or slightly changed; texts of any length.

    The question as a dictionary must leave ``explained`` of the compressed answer at most (or no more than
    the bare block), ``covered`` of the answer's letter groups must be the question's, and half of the
    question's groups the answer's."""
    import zstandard

    q, a = _plain(question), _plain(answer)
    raw_q, raw_a = q.encode("utf-8", "surrogatepass"), a.encode("utf-8", "surrogatepass")
    alone = len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(raw_a)) - FRAME
    known = zstandard.ZstdCompressionDict(raw_q * (1 + BLOCK // max(1, len(raw_q))) + b"  ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)  # a dictionary has eight bytes at least
    given = len(zstandard.ZstdCompressor(level=3, write_content_size=False, dict_data=known).compress(raw_a)) - FRAME
    if given > max(explained * alone, BLOCK):
        return False
    grams_q, grams_a = ({t[k : k + 4] for k in range(max(1, len(t) - 3))} for t in (q, a))
    both = len(grams_q & grams_a)
    return both >= covered * len(grams_a) and both >= 0.5 * len(grams_q)


def _sessions(batch: pa.RecordBatch) -> Iterator[tuple[int, list[tuple]]]:
    """rec_id and the messages as (role, content, call ids or None, tool_call_id)."""
    lists = batch.column(1)
    flat = lists.flatten()
    role = [(r or "").strip().lower() for r in flat.field("role").to_pylist()] if len(flat) else []
    content = flat.field("content").to_pylist() if len(flat) else []
    calls = flat.field("tool_calls")
    ids = calls.flatten().field("id").to_pylist() if len(flat) else []
    sizes = [n or 0 for n in pa.compute.list_value_length(calls).to_pylist()] if len(flat) else []
    answers = flat.field("tool_call_id").to_pylist() if len(flat) else []
    valid = flat.is_valid().to_pylist() if len(flat) else []
    at = call_at = 0
    for rec, n in zip(batch.column(0).to_pylist(), pa.compute.list_value_length(lists).to_pylist()):
        messages = []
        for k in range(at, at + (n or 0)):
            messages.append((role[k] if valid[k] else "", content[k] if valid[k] else None, ids[call_at : call_at + sizes[k]], answers[k] if valid[k] else None))
            call_at += sizes[k]
        at += n or 0
        yield rec, messages


def _turns(messages: list[tuple]) -> Iterator[tuple[int, str | None, str | None]]:
    """(place of the user message, question, answer): the last assistant message without calls before the next user's."""
    place, answer = None, None
    for k, (role, content, calls, _) in enumerate(messages):
        if role == "user":
            if place is not None:
                yield place, messages[place][1], answer
            place, answer = k, None
        elif role == "assistant" and not calls and place is not None:
            answer = content
    if place is not None:
        yield place, messages[place][1], answer


def pair_defect(question: str | None, answer: str | None) -> str | None:
    """empty, refusal, echo, language or None; truncation needs the counts of all answers."""
    if not visible(answer):
        return "empty"
    if is_refusal(answer):
        return "refusal"
    if visible(question):
        if is_echo(question, answer):
            return "echo"
        said = language(answer, 3.0)
        if said is not None:
            asked = language(question, 3.0)
            if asked is not None and asked != said and not _ASKS.search(question):
                return "language"
    return None


def _tool_defects(messages: list[tuple]) -> Iterator[tuple[int, str]]:
    made: set = set()
    waiting: dict = {}
    unanswered: set[int] = set()
    for k, (role, _, calls, answers) in enumerate(messages):
        if role == "tool":
            if answers is None or answers not in made:
                yield k, "tool_orphan"
            else:
                for m in waiting.pop(answers, ()):
                    m[1].discard(answers)
        if role == "assistant" and calls:
            entry = (k, {c for c in calls if c is not None})
            if None in calls:
                unanswered.add(k)
            for c in entry[1]:
                made.add(c)
                waiting.setdefault(c, []).append(entry)
    for entries in waiting.values():
        for k, left in entries:
            if left:
                unanswered.add(k)
    for k in sorted(unanswered):
        yield k, "tool_unanswered"


def certain_defects(sessions: DataFrame) -> DataFrame:
    """rec_id, msg_no, defect of all defects that a session shows by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for rec, messages in _sessions(batch):
                out.extend((rec, k, d) for k, d in _tool_defects(messages))
                out.extend((rec, k, d) for k, q, a in _turns(messages) if (d := pair_defect(q, a)))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.string())], names=["rec_id", "msg_no", "defect"])

    return sessions.where("messages is not null").select(F.col("rec_id").cast("bigint"), "messages").mapInArrow(run, "rec_id bigint, msg_no int, defect string")


def answers(sessions: DataFrame) -> DataFrame:
    """rec_id, item_no (the user message's place), kind, text: the visible answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(rec, k, a) for rec, messages in _sessions(batch) for k, _, a in _turns(messages) if visible(a)]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()), pa.array(["assistant"] * len(out), pa.string()), pa.array([o[2] for o in out], pa.string())], names=["rec_id", "item_no", "kind", "text"])

    return sessions.where("messages is not null").select(F.col("rec_id").cast("bigint"), "messages").mapInArrow(run, "rec_id bigint, item_no int, kind string, text string")


def broken_pairs(sessions: DataFrame) -> DataFrame:
    """rec_id, msg_no, defect.  A pair has at most one of empty, refusal, echo, language, truncated, in this
    order.  Null and empty sessions have no pair; equal rows give equal answers; an empty table none."""
    certain = durable(certain_defects(sessions))  # read twice; a few rows a thousand sessions
    cut = cut_texts(answers(sessions)).where("cut_end or cut_start").select("rec_id", F.col("item_no").alias("msg_no"))
    known = certain.where(~F.col("defect").startswith("tool_")).select("rec_id", "msg_no")
    return certain.unionByName(cut.join(known, ["rec_id", "msg_no"], "left_anti").withColumn("defect", F.lit("truncated"))).distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken_pairs(both_session_tables(spark, sf_dir))


QUERIES = {"p2_found": p2_found}
