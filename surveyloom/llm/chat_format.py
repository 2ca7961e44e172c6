"""Chat formatting: layouts recognised by schema fingerprint, mapped declaratively to turns, templated reversibly."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Names that mean the same role where a layout names its speakers.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant"}
#: Fields beside a layout's own ones, of a record and of a message, that hold no text of a turn.
RECORD_EXTRAS = ("id", "source", "category", "lang", "language", "model", "dataset", "metadata", "meta", "tags", "score", "timestamp", "created_at")
MESSAGE_EXTRAS = ("id", "name", "weight", "score", "timestamp", "created_at", "metadata")


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns: a list of messages (with its role and text keys, and the names of roles), or single fields in order with their roles (several fields of a turn are joined by a blank line)."""

    list_key: str | None = None
    role_key: str = "role"
    text_key: str = "content"
    roles: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()


_SIGN = re.compile(r"[.\[\]=]")


def paths(value) -> set[str]:
    """The paths of a nested value's leaves, signs of paths in keys as ``~``; list items share one path (``[]``), an empty list is one of its own (``[0]``), as is a list's item that is neither list nor object (``[]=``)."""
    found, todo = set(), [("", value)]
    while todo:
        at, x = todo.pop()
        if isinstance(x, dict) and x:
            todo += [(f"{at}.{_SIGN.sub(r'~', k)}", v) for k, v in x.items()]
        elif isinstance(x, list) and x:
            todo += [(f"{at}[]" if isinstance(v, dict | list) else f"{at}[]=", v) for v in x]
        else:
            found.add(f"{at}[0]" if isinstance(x, list) else at)
    return found


_EXTRA = re.compile(rf"\.({'|'.join(RECORD_EXTRAS)})([.\[].*)?|\.\w+\[\]\.({'|'.join(MESSAGE_EXTRAS)})([.\[].*)?", re.DOTALL)


def fingerprint(found: set[str]) -> str:
    """Hash of a set of paths, whatever their order, without those of extra fields."""
    return hashlib.sha256("\n".join(sorted(p for p in found if not _EXTRA.fullmatch(p))).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def known_layouts() -> dict[str, Mapping]:
    """Mapping by schema fingerprint, made from lists of layouts with their optional fields."""
    out: dict[str, Mapping] = {}
    for key in ("messages", "conversations", "conversation", "turns", "dialog"):
        out[fingerprint({f".{key}[0]"})] = Mapping(list_key=key)
        for role in ("role", "from", "speaker"):
            named = () if role == "role" else tuple(ROLES.items())
            for text in ("content", "value", "text", "message"):
                plain, parts = f".{key}[].{text}", {f".{key}[].{text}[].type", f".{key}[].{text}[].text"}
                for said in ({plain}, parts, parts | {plain}, {plain, f".{key}[].{text}[0]"}):  # a text, or a list of parts
                    out[fingerprint({f".{key}[].{role}", *said})] = Mapping(key, role, text, named)
    for answer in ("output", "response", "completion", "answer", "chosen"):
        for ask in (("instruction",), ("instruction", "input"), ("instruction", "context"), ("prompt",), ("question",), ("question", "context")):
            for system in ("", "system", "system_prompt"):
                named = {f".{x}" for x in (*ask, answer, system) if x}
                turns = [("system", (system,))] if system else []
                out[fingerprint(named)] = Mapping(fields=(*turns, ("user", ask), ("assistant", (answer,))))
    return out


def _said(value) -> str:
    """A field as text: null is empty, a list of parts its texts, other values their JSON; half a surrogate pair becomes U+FFFD."""
    if isinstance(value, list) and all(isinstance(x, dict) for x in value):
        value = "\n".join(x["text"] if isinstance(x.get("text"), str) else "" for x in value)
    text = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def canonical(record: str | None, layouts: dict[str, Mapping], cache: dict) -> list[tuple[str, str]] | None:
    """The turns (role, text) of a JSON record; None if it can't be read or its layout has no mapping."""
    try:
        value = json.loads(record) if record is not None else None
    except (ValueError, RecursionError):  # no JSON, or nested too deeply for the reader
        return None
    if not isinstance(value, dict):
        return None
    found = frozenset(paths(value))
    if found not in cache:
        if len(cache) >= 10_000:  # of schemas seen, so that a worker's memory is bounded
            cache.clear()
        cache[found] = layouts.get(fingerprint(set(found)))
    how = cache[found]
    if how is None:
        return None
    if how.list_key:
        names = dict(how.roles)
        turns = [(_said(m.get(how.role_key)), _said(m.get(how.text_key))) for m in value[how.list_key]]
        return [(names.get(role, role), text) for role, text in turns]
    return [(role, "\n\n".join(t for f in names if (t := _said(value.get(f))))) for role, names in how.fields]


_MARK, _MARKED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: a backslash more between the two. unescape() takes one away."""
    return _MARK.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def render(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the code-point ranges of the texts to learn from."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == learn:
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation: render() read back."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape_role(role), unescape(rest[: -len(END) - 1])))
    return turns


def format_chats(records: DataFrame, id_col: str = "conv_id", record_col: str = "record") -> DataFrame:
    """One row per record: (id, formatted, loss array<struct<start,end>>, status).

    ``record_col`` is JSON of any layout of known_layouts(): lists of messages under several
    names, or prompt, instruction and answer fields.  The layout is chosen by the hash of the
    record's field paths alone, but for extra fields that hold no turn (RECORD_EXTRAS,
    MESSAGE_EXTRAS).  A record that isn't a JSON object, that no reader can nest, or whose layout
    is unknown (messages that are no objects, say) keeps its row, status ``unmapped``,
    formatted null.  No messages give an empty text.  Nulls in a known field are empty texts.
    Repeated rows are formatted each.  Ids are cast to long; other columns are ignored.
    """

    def run(batches):
        layouts, cache = known_layouts(), {}
        for batch in batches:
            formatted, loss, status = [], [], []
            for record in batch.column(1).to_pylist():
                turns = canonical(record, layouts, cache)
                text, mask = render(turns) if turns is not None else (None, [])
                formatted.append(text)
                loss.append([{"start": a, "end": b} for a, b in mask])
                status.append("ok" if turns is not None else "unmapped")
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(formatted, pa.string()), pa.array(loss, kind), pa.array(status, pa.string())], names=["id", "formatted", "loss", "status"])

    src = records.select(F.col(id_col).cast("long").alias("id"), F.col(record_col).alias("record"))
    return src.mapInArrow(run, "id long, formatted string, loss array<struct<start:long,end:long>>, status string")


def read_back(formatted: DataFrame) -> DataFrame:
    """What a formatted table holds, from its text and mask alone: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for i, text, mask in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = text or ""
                turns = parse(text)
                learned = "".join(unescape(text[m["start"] : m["end"]]) for m in mask or ())
                digest = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
                for k, v in zip(out, (i, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), digest(learned), len(text)), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

    return formatted.select("id", "formatted", "loss").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: Layouts in which gather() writes records, with their role and text fields.
GATHERED = (("messages", "role", "content"), ("turns", "role", "text"), ("dialog", "role", "message"))


def gather(rows: DataFrame) -> DataFrame:
    """(conv_id, record): turn rows as one JSON record a conversation, by turn (then role, text).

    The layouts of GATHERED take turns by conversation id, so that what formats the records
    must tell them apart.  Null texts and roles are empty; a null turn comes first; rows
    without conv_id are one conversation.
    """
    turn = F.struct(F.col("turn").alias("n"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def record(key: str, role: str, text: str) -> Column:
        return F.to_json(F.struct(F.transform("turns", lambda x: F.struct(x["role"].alias(role), x["text"].alias(text))).alias(key)))

    layout = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(len(GATHERED)))
    made = record(*GATHERED[0])
    for i, names in enumerate(GATHERED[1:], 1):
        made = F.when(layout == i, record(*names)).otherwise(made)
    return turns.select("conv_id", made.alias("record"))
