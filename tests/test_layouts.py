"""The layouts of all built-in templates, spelled out: two turns, with the template's own system text and with ``S``."""

from loomwork.functions.templates import TEMPLATES
from loomwork.operators import encode

# The texts models were trained on, then stop words, whether turns end in one end token only, whether history is used.
GOLDEN = {
    'vanilla': ('Q1A1</s>Q2A2</s>',
        'Q1A1</s>Q2A2</s>', [], False, False),
    'default': ("A chat between a curious user and an artificial intelligence assistant. The assistant gives helpful, detailed, and polite answers to the user's questions.\nHuman: Q1\nAssistant: A1</s>\nHuman: Q2\nAssistant: A2</s>",
        'S\nHuman: Q1\nAssistant: A1</s>\nHuman: Q2\nAssistant: A2</s>', [], False, True),
    'llama2': ("[INST] <<SYS>>\nYou are a helpful, respectful and honest assistant. Always answer as helpfully as possible, while being safe.  Your answers should not include any harmful, unethical, racist, sexist, toxic, dangerous, or illegal content. Please ensure that your responses are socially unbiased and positive in nature.\n\nIf a question does not make any sense, or is not factually coherent, explain why instead of answering something not correct. If you don't know the answer to a question, please don't share false information.\n<</SYS>>\n\nQ1 [/INST] A1</s>[INST] Q2 [/INST] A2</s>",
        '[INST] <<SYS>>\nS\n<</SYS>>\n\nQ1 [/INST] A1</s>[INST] Q2 [/INST] A2</s>', [], False, True),
    'llama2_zh': ('[INST] <<SYS>>\nYou are a helpful assistant. 你是一个乐于助人的助手。\n<</SYS>>\n\nQ1 [/INST] A1</s>[INST] Q2 [/INST] A2</s>',
        '[INST] <<SYS>>\nS\n<</SYS>>\n\nQ1 [/INST] A1</s>[INST] Q2 [/INST] A2</s>', [], False, True),
    'alpaca': ('Below is an instruction that describes a task. Write a response that appropriately completes the request.\n\n### Instruction:\nQ1\n\n### Response:\nA1</s>\n\n### Instruction:\nQ2\n\n### Response:\nA2</s>',
        'S\n\n### Instruction:\nQ1\n\n### Response:\nA1</s>\n\n### Instruction:\nQ2\n\n### Response:\nA2</s>', [], False, True),
    'vicuna': ("A chat between a curious user and an artificial intelligence assistant. The assistant gives helpful, detailed, and polite answers to the user's questions.USER: Q1 ASSISTANT:A1</s>USER: Q2 ASSISTANT:A2</s>",
        'SUSER: Q1 ASSISTANT:A1</s>USER: Q2 ASSISTANT:A2</s>', [], False, True),
    'belle': ('Human: Q1\n\nBelle: A1</s>\n\nHuman: Q2\n\nBelle: A2</s>',
        'S\n\nHuman: Q1\n\nBelle: A1</s>\n\nHuman: Q2\n\nBelle: A2</s>', [], False, True),
    'ziya': ('<human>:Q1\n<bot>:A1</s>\n<human>:Q2\n<bot>:A2</s>',
        'S\n<human>:Q1\n<bot>:A1</s>\n<human>:Q2\n<bot>:A2</s>', [], False, True),
    'aquila': ("A chat between a curious human and an artificial intelligence assistant. The assistant gives helpful, detailed, and polite answers to the human's questions.###Human: Q1###Assistant:A1###Human: Q2###Assistant:A2",
        'S###Human: Q1###Assistant:A1###Human: Q2###Assistant:A2', ['</s>'], True, True),
    'intern': ('<|User|>:Q1<eoh>\n<|Bot|>:A1<eoa>\n<|User|>:Q2<eoh>\n<|Bot|>:A2',
        'S<eoa>\n<|User|>:Q1<eoh>\n<|Bot|>:A1<eoa>\n<|User|>:Q2<eoh>\n<|Bot|>:A2', ['<eoa>'], True, True),
    'baichuan': ('<reserved_102>Q1<reserved_103>A1<reserved_102>Q2<reserved_103>A2',
        'S<reserved_102>Q1<reserved_103>A1<reserved_102>Q2<reserved_103>A2', [], True, True),
    'baichuan2': ('<reserved_106>Q1<reserved_107>A1<reserved_106>Q2<reserved_107>A2',
        'S<reserved_106>Q1<reserved_107>A1<reserved_106>Q2<reserved_107>A2', [], True, True),
    'starchat': ('<|system|>\n<|end|>\n<|user|>\nQ1<|end|>\n<|assistant|>A1<|end|>\n<|user|>\nQ2<|end|>\n<|assistant|>A2',
        '<|system|>\nS<|end|>\n<|user|>\nQ1<|end|>\n<|assistant|>A1<|end|>\n<|user|>\nQ2<|end|>\n<|assistant|>A2', ['<|end|>'], True, True),
    'chatml': ('<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<|im_start|>user\nQ1<|im_end|>\n<|im_start|>assistant\nA1<|im_end|>\n<|im_start|>user\nQ2<|im_end|>\n<|im_start|>assistant\nA2',
        '<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nQ1<|im_end|>\n<|im_start|>assistant\nA1<|im_end|>\n<|im_start|>user\nQ2<|im_end|>\n<|im_start|>assistant\nA2', ['<|im_end|>'], True, True),
    'chatglm2': ('[gMASK]sop\n\n[Round 0]\n\n问：Q1\n\n答：A1\n\n[Round 1]\n\n问：Q2\n\n答：A2',
        '[gMASK]sopS\n\n[Round 0]\n\n问：Q1\n\n答：A1\n\n[Round 1]\n\n问：Q2\n\n答：A2', [], True, True),
    'chatglm3': ('[gMASK]sop<|user|>\nQ1<|assistant|>A1<|user|>\nQ2<|assistant|>A2',
        '[gMASK]sopS<|user|>\nQ1<|assistant|>A1<|user|>\nQ2<|assistant|>A2', ['<|user|>', '<|observation|>'], True, True),
    'openchat': ('GPT4 User: Q1<|end_of_turn|>GPT4 Assistant:A1<|end_of_turn|>GPT4 User: Q2<|end_of_turn|>GPT4 Assistant:A2',
        'S<|end_of_turn|>GPT4 User: Q1<|end_of_turn|>GPT4 Assistant:A1<|end_of_turn|>GPT4 User: Q2<|end_of_turn|>GPT4 Assistant:A2', [], True, True),
    'xverse': ('Human: Q1\n\nAssistant: A1</s>Human: Q2\n\nAssistant: A2</s>',
        'SHuman: Q1\n\nAssistant: A1</s>Human: Q2\n\nAssistant: A2</s>', [], False, True),
}


def test_layouts(spark):
    for name, (own, given, stop_words, efficient_eos, use_history) in GOLDEN.items():
        template = TEMPLATES[name]
        assert (list(template.stop_words), template.efficient_eos, template.use_history) == (stop_words, efficient_eos, use_history), name
        turns = spark.createDataFrame(
            [(i, t, f"Q{t + 1}", f"A{t + 1}", system) for i, system in enumerate([template.system, "S"]) for t in range(2)],
            "i int, t int, query string, response string, system string").coalesce(1)
        rows = sorted(encode.render_turn_rows(turns, template).collect(), key=lambda r: (r.i, r.t))
        assert ["".join(r.text for r in rows if r.i == i) for i in range(2)] == [own, given], name


def test_no_template_is_unpinned():
    assert set(GOLDEN) <= set(TEMPLATES) and len(GOLDEN) == 18
