"""Tokenizers as the JSON files that other tools read: one file for the model, two for its roles.

The files are bounded by the vocabulary, so the driver writes and reads them. The reader is strict:
a file that asks for anything this engine would do differently is refused.
"""

from __future__ import annotations

import json

from pyarrow import fs

from corpusmill.operators.tokenizer import Tokenizer
from corpusmill.sources.ranges import opened

# Names of the files, and the flags of a special token.
MODEL_FILE = "tokenizer.json"
CONFIG_FILE = "tokenizer_config.json"
SPECIALS_FILE = "special_tokens_map.json"
FLAGS = ("single_word", "lstrip", "rstrip", "normalized")


def model_document(tok: Tokenizer) -> dict:
    """Content of the model file."""
    special = [
        {"id": tok.ids[s], "content": s, **dict.fromkeys(FLAGS, False), "special": True} for s in tok.specials
    ]
    byte_level = {"type": "ByteLevel", "add_prefix_space": tok.add_prefix_space, "trim_offsets": True, "use_regex": True}
    return {
        "version": "1.0",
        "truncation": None,
        "padding": None,
        "added_tokens": special,
        "normalizer": {"type": "NFKC"} if tok.normalize else None,
        "pre_tokenizer": byte_level,
        "post_processor": None,
        "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True},
        "model": {
            "type": "BPE",
            "dropout": None,
            "unk_token": tok.unk_token,
            "continuing_subword_prefix": tok.continuing_prefix or None,
            "end_of_word_suffix": None,
            "fuse_unk": False,
            "byte_fallback": False,
            "ignore_merges": False,
            "vocab": tok.ids,
            "merges": [list(pair) for pair in tok.merges],
        },
    }


def _roles(tok: Tokenizer) -> dict[str, str]:
    return {r: getattr(tok, r) for r in ("bos_token", "eos_token", "pad_token", "unk_token")}


def chat_template(tok: Tokenizer) -> str:
    """The frame of :func:`~corpusmill.functions.chat.render_chat` as a Jinja template."""
    roles = ", ".join(f"'{r}'" for r in tok.chat_roles)
    turn = f"{tok.bos_token}{{{{ m['role'] }}}}\n{{{{ m['content'] }}}}{tok.eos_token}\n"
    loop = f"{{% for m in messages if m['role'] in [{roles}] %}}{turn}{{% endfor %}}"
    return loop + f"{{% if add_generation_prompt %}}{tok.bos_token}assistant\n{{% endif %}}"


def config_document(tok: Tokenizer) -> dict:
    return {
        "add_bos_token": False,
        "add_eos_token": False,
        "add_prefix_space": tok.add_prefix_space,
        **_roles(tok),
        "model_max_length": tok.model_max_length,
        "clean_up_tokenization_spaces": False,
        "tokenizer_class": "PreTrainedTokenizerFast",
        "chat_template": chat_template(tok),
    }


def specials_document(tok: Tokenizer) -> dict:
    roles = _roles(tok)
    others = [s for s in tok.specials if s not in roles.values()]
    return {**roles, "additional_special_tokens": others}


def write_tokenizer_files(tok: Tokenizer, folder: str) -> None:
    """Write the three files into a folder, which is made where it is missing."""
    system, own = opened(folder)
    system.create_dir(own, recursive=True)
    documents = {MODEL_FILE: model_document, CONFIG_FILE: config_document, SPECIALS_FILE: specials_document}
    for name, document in documents.items():
        with system.open_output_stream(f"{own}/{name}") as file:
            file.write(json.dumps(document(tok), ensure_ascii=False, indent=1).encode())


def _ask(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(f"tokenizer file: {what}")


def _pairs(merges: list) -> list[tuple[str, str]]:
    """Merges as pairs; older files write a pair as one text with a space."""
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
    _ask(all(len(p) == 2 for p in pairs), "a merge is not a pair")
    return pairs


def tokenizer_from(document: dict, roles: dict | None = None) -> Tokenizer:
    """The tokenizer of a model file's content; ``roles`` are those of the other files."""
    model, roles = document["model"], roles or {}
    _ask(model.get("type", "BPE") == "BPE", "the model is not byte-pair encoding")
    for key in ("dropout", "end_of_word_suffix", "byte_fallback", "ignore_merges"):
        _ask(not model.get(key), f"{key} is not supported")
    normalizer, before = document.get("normalizer"), document.get("pre_tokenizer") or {}
    _ask(normalizer is None or normalizer.get("type") == "NFKC", "the normalizer is neither NFKC nor none")
    _ask(before.get("type") == "ByteLevel" and before.get("use_regex", True), "words are not cut at byte level")
    _ask((document.get("decoder") or {}).get("type") == "ByteLevel", "the decoder is not at byte level")
    _ask(document.get("post_processor") is None or document["post_processor"].get("type") == "ByteLevel",
         "tokens are added behind the model")

    ids = dict(model["vocab"])
    added = sorted(document.get("added_tokens") or [], key=lambda t: t["id"])
    for token in added:
        _ask(token.get("special", False) and not any(token.get(f) for f in FLAGS), f"flags of {token['content']}")
        _ask(ids.setdefault(token["content"], token["id"]) == token["id"], f"two ids of {token['content']}")
    tokens = sorted(ids, key=ids.__getitem__)
    _ask([ids[t] for t in tokens] == list(range(len(tokens))), "ids have gaps or repeat")
    prefix = model.get("continuing_subword_prefix") or ""
    merges = _pairs(model["merges"])
    for left, right in merges:
        _ask({left, right, left + right[len(prefix) :]} <= ids.keys(), f"merge of unknown tokens {left} {right}")
    named = {r: _content(roles[r]) for r in ("bos_token", "eos_token", "pad_token") if roles.get(r)}
    named["unk_token"] = model.get("unk_token") or _content(roles.get("unk_token", "<unk>"))
    _ask(set(named.values()) <= ids.keys(), "a role's token is not in the vocabulary")
    length = roles.get("model_max_length")
    return Tokenizer(
        tokens=tuple(tokens),
        merges=tuple(merges),
        specials=tuple(t["content"] for t in added),
        add_prefix_space=bool(before.get("add_prefix_space", False)),
        continuing_prefix=prefix,
        normalize=normalizer is not None,
        **named,
        **({"model_max_length": length} if isinstance(length, int) else {}),
    )


def _content(token: str | dict) -> str:
    return token["content"] if isinstance(token, dict) else token


def _read(system: fs.FileSystem, path: str) -> dict:
    if system.get_file_info(path).type != fs.FileType.File:
        return {}
    with system.open_input_stream(path) as file:
        return json.loads(file.read())


def read_tokenizer_files(folder: str) -> Tokenizer:
    """The tokenizer of a folder's model file, with roles from the other files where they are."""
    system, own = opened(folder)
    document = _read(system, f"{own}/{MODEL_FILE}")
    _ask(bool(document), f"no {MODEL_FILE} in {folder}")
    return tokenizer_from(document, _read(system, f"{own}/{SPECIALS_FILE}") | _read(system, f"{own}/{CONFIG_FILE}"))
