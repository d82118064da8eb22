"""Chat templates: plain settings on the driver, compiled to Column expressions by the encoder.

A template part is a tuple of pieces. A ``str`` piece is text, in which ``{{system}}``,
``{{query}}`` and ``{{idx}}`` are slots; a ``Special`` piece stands for one vocabulary id.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Special:
    token: str


Piece = str | Special


@dataclass(frozen=True)
class ChatTemplate:
    name: str
    prefix: tuple[Piece, ...]
    prompt: tuple[Piece, ...]
    sep: tuple[Piece, ...]
    system: str
    stop_words: tuple[str, ...] = ()
    use_history: bool = True
    efficient_eos: bool = False

    @property
    def system_in_query(self) -> bool:
        """The system block is part of the first user text instead of standing before it."""
        return "llama2" in self.name

    def special_tokens(self) -> list[str]:
        """Tokens that must have an id of their own: stop words first, then the pieces."""
        pieces = self.prefix + self.prompt + self.sep
        return list(dict.fromkeys([*self.stop_words, *(p.token for p in pieces if isinstance(p, Special))]))


TEMPLATES: dict[str, ChatTemplate] = {}


def register_template(name: str, prefix=(), prompt=("{{query}}",), sep=(), system: str = "",
                      stop_words=(), use_history: bool = True, efficient_eos: bool = False) -> ChatTemplate:
    """Add a template, or replace the one of that name."""
    template = ChatTemplate(name, tuple(prefix), tuple(prompt), tuple(sep), system, tuple(stop_words),
                            use_history, efficient_eos)
    TEMPLATES[name] = template
    return template


def get_template(template: str | ChatTemplate) -> ChatTemplate:
    if isinstance(template, ChatTemplate):
        return template
    if template not in TEMPLATES:
        raise ValueError(f"no template named {template!r}; known: {', '.join(TEMPLATES)}")
    return TEMPLATES[template]


# System texts and layouts of the built-in templates. Model vocabularies were
# trained on exactly these characters.

ASSISTANT_CHAT = (
    "A chat between a curious user and an artificial intelligence assistant. "
    "The assistant gives helpful, detailed, and polite answers to the user's questions."
)

HUMAN_CHAT = (
    "A chat between a curious human and an artificial intelligence assistant. "
    "The assistant gives helpful, detailed, and polite answers to the human's questions."
)

LLAMA2_SYSTEM = (
    "You are a helpful, respectful and honest assistant. "
    "Always answer as helpfully as possible, while being safe.  "
    "Your answers should not include any harmful, unethical, "
    "racist, sexist, toxic, dangerous, or illegal content. "
    "Please ensure that your responses are socially unbiased and positive in nature.\n\n"
    "If a question does not make any sense, or is not factually coherent, "
    "explain why instead of answering something not correct. "
    "If you don't know the answer to a question, please don't share false information."
)

ALPACA_SYSTEM = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)

SYSTEM = "{{system}}"
LLAMA2_PREFIX = "<<SYS>>\n{{system}}\n<</SYS>>\n\n"
LLAMA2_PROMPT = "[INST] {{query}} [/INST] "

register_template("vanilla", prompt=["{{query}}"], use_history=False)
register_template("default", [SYSTEM], ["Human: {{query}}\nAssistant: "], ["\n"], ASSISTANT_CHAT)
register_template("llama2", [LLAMA2_PREFIX], [LLAMA2_PROMPT], [], LLAMA2_SYSTEM)
register_template("llama2_zh", [LLAMA2_PREFIX], [LLAMA2_PROMPT], [],
                  "You are a helpful assistant. 你是一个乐于助人的助手。")
register_template("alpaca", [SYSTEM], ["### Instruction:\n{{query}}\n\n### Response:\n"], ["\n\n"], ALPACA_SYSTEM)
register_template("vicuna", [SYSTEM], ["USER: {{query}} ASSISTANT:"], [], ASSISTANT_CHAT)
register_template("belle", [SYSTEM], ["Human: {{query}}\n\nBelle: "], ["\n\n"])
register_template("ziya", [SYSTEM], [Special("<human>"), ":{{query}}\n", Special("<bot>"), ":"], ["\n"])
register_template("aquila", [SYSTEM], ["Human: {{query}}###Assistant:"], ["###"], HUMAN_CHAT,
                  stop_words=["</s>"], efficient_eos=True)
register_template("intern", [SYSTEM], ["<|User|>:{{query}}", Special("<eoh>"), "\n<|Bot|>:"],
                  [Special("<eoa>"), "\n"], stop_words=["<eoa>"], efficient_eos=True)
register_template("baichuan", [SYSTEM], [Special("<reserved_102>"), "{{query}}", Special("<reserved_103>")],
                  efficient_eos=True)
register_template("baichuan2", [SYSTEM], [Special("<reserved_106>"), "{{query}}", Special("<reserved_107>")],
                  efficient_eos=True)
register_template("starchat", [Special("<|system|>"), "\n{{system}}"],
                  [Special("<|user|>"), "\n{{query}}", Special("<|end|>"), "\n", Special("<|assistant|>")],
                  [Special("<|end|>"), "\n"], stop_words=["<|end|>"], efficient_eos=True)
register_template("chatml", [Special("<|im_start|>"), "system\n{{system}}"],
                  [Special("<|im_start|>"), "user\n{{query}}", Special("<|im_end|>"), "\n",
                   Special("<|im_start|>"), "assistant\n"],
                  [Special("<|im_end|>"), "\n"], "You are a helpful assistant.",
                  stop_words=["<|im_end|>"], efficient_eos=True)
register_template("chatglm2", [Special("[gMASK]"), Special("sop"), SYSTEM],
                  ["[Round {{idx}}]\n\n问：{{query}}\n\n答："], ["\n\n"], efficient_eos=True)
register_template("chatglm3", [Special("[gMASK]"), Special("sop"), SYSTEM],
                  [Special("<|user|>"), "\n", "{{query}}", Special("<|assistant|>")],
                  stop_words=["<|user|>", "<|observation|>"], efficient_eos=True)
register_template("openchat", [SYSTEM], ["GPT4 User: {{query}}", Special("<|end_of_turn|>"), "GPT4 Assistant:"],
                  [Special("<|end_of_turn|>")], efficient_eos=True)
register_template("xverse", [SYSTEM], ["Human: {{query}}\n\nAssistant: "])

# End of fixed values.


@dataclass(frozen=True)
class Slot:
    name: str


def split_slots(piece: str, slots: tuple[str, ...]) -> list[str | Slot]:
    """Cut a text piece at the first occurrence of each given slot; text in between stays literal."""
    found = sorted((piece.find("{{%s}}" % s), s) for s in slots if "{{%s}}" % s in piece)
    parts: list[str | Slot] = []
    done = 0
    for at, slot in found:
        parts += [piece[done:at], Slot(slot)]
        done = at + len(slot) + 4
    parts.append(piece[done:])
    return [p for p in parts if p != ""]
