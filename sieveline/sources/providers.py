"""Probes of two annotation providers through a requester that the caller gives; nothing here opens a connection.

A requester takes (method, url, headers, payload) and returns a Reply. Keys are looked up by the name of their variable,
compared, sent, and never stored or shown.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from sieveline.operators.annotation import MODES

#: models that a report lists, at most
LISTED = 20
PROBE = {"messages": [{"role": "user", "content": 'Return exactly: {"probe":"ok"}'}], "max_tokens": 16}


@dataclass(frozen=True)
class Provider:
    name: str
    model: str
    url: str
    key_variable: str


@dataclass(frozen=True)
class Reply:
    status: int | None
    body: object = None
    error: str | None = None
    headers: Mapping[str, str] = field(default_factory=dict)


def _call(provider: Provider, variables: Mapping[str, str], requester: Callable, method: str, path: str, payload: dict | None = None) -> tuple[Reply, int]:
    began = time.monotonic()
    try:
        reply = requester(method, f"{provider.url.rstrip('/')}/{path}", {"Authorization": f"Bearer {variables[provider.key_variable]}"}, payload)
    except Exception as e:  # noqa: BLE001 a provider that can't be reached is a row
        reply = Reply(None, error=type(e).__name__)
    return reply, round((time.monotonic() - began) * 1000)


def distinct_keys(a: Provider, b: Provider, variables: Mapping[str, str]) -> bool | None:
    """Whether both keys are there and differ; None if one is absent."""
    first, second = (variables.get(p.key_variable) for p in (a, b))
    return first != second if first and second else None


def model_excerpt(models: list[str], wanted: str, most: int = LISTED) -> list[str]:
    """The models of the wanted one's family, by the first part of its name; the wanted one is always among them."""
    family = wanted.split("-", 1)[0].lower()
    own = [m for m in models if family in m.lower()]
    return (own if wanted in own or wanted not in models else [wanted, *own])[:most]


def discover(provider: Provider, variables: Mapping[str, str], requester: Callable | None, verified: list[str] | None = None) -> dict:
    """What models a provider has: by asking it, or by a list that its owner has verified."""
    status, error, source = None, None, "verified"
    if verified is None:
        reply, _ = _call(provider, variables, requester, "GET", "models")
        status, error, source = reply.status, reply.error, "asked"
        listed = reply.body.get("data") if isinstance(reply.body, dict) else reply.body
        verified = [m["id"] if isinstance(m, dict) else m for m in listed if isinstance(m, str) or (isinstance(m, dict) and isinstance(m.get("id"), str))] if isinstance(listed, list) else []
    models = list(dict.fromkeys(verified))
    found = provider.model in models
    return {"provider": provider.name, "status": status, "source": source, "models": len(models), "relevant_models": model_excerpt(models, provider.model), "accessible": found, "error": error or (None if found else "model_missing")}


def identity(provider: Provider, variables: Mapping[str, str], requester: Callable) -> dict:
    """Whether the provider answers with the very model that was asked for."""
    reply, took = _call(provider, variables, requester, "POST", "chat/completions", PROBE | {"model": provider.model})
    resolved = reply.body.get("model") if isinstance(reply.body, dict) else None
    good = reply.status is not None and 200 <= reply.status < 300
    failure = None
    if reply.status in (401, 403):
        failure = "auth_error"
    elif reply.status is None:
        failure = "transport_error"
    elif not good:
        failure = "provider_error"
    elif resolved != provider.model:
        failure = "resolved_model_mismatch" if resolved else "resolved_model_missing"
    return {"provider": provider.name, "model": provider.model, "resolved_model": resolved, "status": reply.status, "passed": failure is None, "failure": failure, "error": reply.error, "latency_ms": took}


def capability(provider: Provider, variables: Mapping[str, str], requester: Callable, prompt: str, valid: Callable[[str], bool]) -> list[dict]:
    """One attempt in each structured-output mode, in their order, until one passes or fails for good: the rows that
    `annotation.negotiation` reads."""
    rows = []
    for mode in MODES:
        form = {"json_schema": {"response_format": {"type": "json_schema"}}, "json_object": {"response_format": {"type": "json_object"}}}.get(mode, {})
        reply, took = _call(provider, variables, requester, "POST", "chat/completions", {"model": provider.model, "messages": [{"role": "user", "content": prompt}], "max_tokens": 1024, **form})
        text = reply.body if isinstance(reply.body, str) else json.dumps(reply.body, ensure_ascii=False)
        resolved = reply.body.get("model") if isinstance(reply.body, dict) else None
        ok = reply.status is not None and 200 <= reply.status < 300
        failure = None
        if reply.status is None:
            failure = "transport_error"
        elif reply.status in (401, 403):
            failure = "auth_error"
        elif not ok:
            failure = "unsupported_mode" if reply.status == 400 and "response_format" in text else "provider_error"
        elif resolved != provider.model:
            failure = "resolved_model_mismatch"
        elif not valid(text):
            failure = "schema_incompatible_mode" if mode == "json_schema" else "parse_error"
        rows.append({"provider": provider.name, "mode": mode, "status": reply.status, "failure": failure, "latency_ms": took})
        if failure not in ("unsupported_mode", "schema_incompatible_mode", "parse_error"):
            break
    return rows


def dual_preflight(a: Provider, b: Provider, variables: Mapping[str, str], requester: Callable, prompt: str, valid: Callable[[str], bool]) -> dict:
    """Identity and capability of both providers. Two providers must have keys of their own: with equal or absent keys
    no request is made; one provider that stands for both may use one key."""
    shared = a.name == b.name and a.key_variable == b.key_variable
    apart = None if shared else distinct_keys(a, b, variables)
    present = {p.key_variable: bool(variables.get(p.key_variable)) for p in (a, b)}
    out = {"keys_present": present, "keys_shared": shared, "keys_distinct": apart, "identity": [], "attempts": [], "passed": False, "error": None}
    if not all(present.values()) or (not shared and not apart):
        return out | {"error": "credential_isolation_failed" if apart is False else "credentials_missing"}
    for p in (a, b):
        out["identity"].append(identity(p, variables, requester))
        if out["identity"][-1]["passed"]:
            out["attempts"].append(capability(p, variables, requester, prompt, valid))
    failures = [i["failure"] for i in out["identity"] if i["failure"]] + [rows[-1]["failure"] for rows in out["attempts"] if rows[-1]["failure"]]
    return out | {"passed": not failures, "error": failures[0] if failures else None}
