"""Plain-Python readings of the encoding rules, written apart from the Spark code to check it."""

from loomwork.functions.templates import Special


def fill(piece, values):
    """Fill the first occurrence of each slot in one left-to-right walk over the template text."""
    out, rest, left = "", piece, set(values)
    while True:
        hits = [(rest.index("{{" + s + "}}"), s) for s in left if "{{" + s + "}}" in rest]
        if not hits:
            return out + rest
        at, slot = min(hits)
        out += rest[:at] + values[slot]
        rest = rest[at + len(slot) + 4:]
        left.discard(slot)


def ids_of(part, values, tok):
    out = []
    for piece in part:
        if isinstance(piece, Special):
            out.append(tok.specials[piece.token])
        else:
            out += [ord(c) for c in fill(piece, values)]
    return out


def encode_pairs(template, tok, turns, system):
    system = system or template.system
    if not template.use_history:
        turns = turns[-1:]
    bos = [tok.specials[tok.bos]] if tok.bos else []
    eos = [] if template.efficient_eos else [tok.specials[tok.eos]]
    pairs = []
    for i, (query, response) in enumerate(turns):
        if template.system_in_query:
            q = fill(template.prefix[0], {"system": system}) + query if i == 0 else query
            src = bos + ids_of(template.prompt, {"query": q}, tok)
        else:
            sep = ids_of(template.sep, {}, tok)
            if i == 0:
                prefix = ids_of(template.prefix, {"system": system}, tok)
                src = bos + (prefix + sep if prefix else [])
            else:
                src = sep + bos
            src = src + ids_of(template.prompt, {"query": query, "idx": str(i)}, tok)
        pairs.append((src, [ord(c) for c in response] + eos))
    return pairs


def encode_example(template, tok, turns, system, cutoff):
    if not turns or turns[-1][0] == "" or turns[-1][1] == "":
        return None
    ids, labels = [], []
    eos = tok.specials[tok.eos]
    for i, (src, tgt) in enumerate(encode_pairs(template, tok, turns, system)):
        total = len(src) + len(tgt)
        src = src[:int(cutoff * (len(src) / total))] if total else src
        tgt = tgt[:int(cutoff * (len(tgt) / total))] if total else tgt
        mask = [-100] * len(src)
        if i and template.efficient_eos and src:
            mask[0] = eos
        ids += src + tgt
        labels += mask + tgt
    if template.efficient_eos:
        ids.append(eos)
        labels.append(eos)
    return ids[:cutoff], labels[:cutoff]


def pair_up(messages):
    """``[(turn, role, text)]`` of one conversation to its system text and its pairs."""
    rows = sorted(messages)
    system = next((x for _, role, x in rows if role == "system"), None)
    pairs = [(a[2], b[2]) for a, b in zip(rows, rows[1:]) if a[1] == "user" and b[1] == "assistant"]
    return system, pairs
