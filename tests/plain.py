"""Plain Python versions of graph steps, one graph at a time: what the library's expressions are compared with."""

from __future__ import annotations

import copy
import re
from collections import defaultdict, deque

from taskloom.functions import fixed
from taskloom.functions.graphs import distance_edges, duration_of, earliest_starts


class Refused(ValueError):
    """The operation cannot be applied to this graph."""


def longest_path(durations: dict[int, int], edges: list[tuple[int, int]]) -> int:
    """Length of the longest chain; activities on a cycle, and what only they reach, keep what they have so far."""
    waiting, after, finish = defaultdict(int), defaultdict(list), dict(durations)
    for i, j in edges:
        after[i].append(j)
        waiting[j] += 1
    ready = deque(k for k in durations if not waiting[k])
    while ready:
        i = ready.popleft()
        for j in after[i]:
            finish[j] = max(finish[j], finish[i] + durations[j])
            waiting[j] -= 1
            if not waiting[j]:
                ready.append(j)
    return max(finish.values(), default=0)


def acyclic(nodes: list[int], edges: list[tuple[int, int]]) -> bool:
    known = set(nodes)
    inner = [(i, j) for i, j in edges if i in known and j in known]
    waiting, after = defaultdict(int), defaultdict(list)
    for i, j in inner:
        after[i].append(j)
        waiting[j] += 1
    ready, done = [k for k in known if not waiting[k]], 0
    while ready:
        done += 1
        for j in after[ready.pop()]:
            waiting[j] -= 1
            if not waiting[j]:
                ready.append(j)
    return done == len(known)


def needs_distances(graph: dict) -> bool:
    return any(p.get("lag_max") is not None or p["relation"] in ("FF", "SF") for p in graph.get("precedences") or [])


def cycle_reason(graph: dict) -> str | None:
    nodes = [a["id"] for a in graph["activities"]]
    if needs_distances(graph):
        return None if earliest_starts(nodes, distance_edges(graph)) is not None else "temporal constraints form a positive cycle"
    return None if acyclic(nodes, [(p["i"], p["j"]) for p in graph.get("precedences") or []]) else "precedences form a cycle"


def _pick(rows: list[dict], key: str, value) -> dict:
    for row in rows:
        if row[key] == value:
            return row
    raise Refused(f"unknown {key} {value}")


def _add_window(graph, m):
    resource = _pick(graph["resources"], "id", m["resource"])
    window = {"start": m["t_start"], "end": m["t_end"], "delta": resource["capacity"] if m["op"] == "freeze_resource" else m["delta"]}
    resource["downtime"] = sorted([*(resource.get("downtime") or []), window], key=lambda w: w["start"])


def _tighten(graph, m):
    edge = next((p for p in graph["precedences"] if (p["i"], p["j"], p["relation"]) == (m["i"], m["j"], m["relation"])), None)
    if edge is None:
        edge = {"i": m["i"], "j": m["j"], "relation": m["relation"], "lag_min": m["lag_min"], "lag_max": m.get("lag_max")}
        graph["precedences"].append(edge)
    else:
        edge["lag_min"] = max(edge["lag_min"], m["lag_min"])
        caps = [x for x in (edge.get("lag_max"), m.get("lag_max")) if x is not None]
        edge["lag_max"] = min(caps) if caps else None
    if edge.get("lag_max") is not None and edge["lag_max"] <= edge["lag_min"]:
        raise Refused("lag_max must be > lag_min")


def _link(graph, m):
    if not any((p["i"], p["j"]) == (m["i"], m["j"]) for p in graph["precedences"]):
        graph["precedences"].append({"i": m["i"], "j": m["j"], "relation": m.get("relation") or "FS", "lag_min": 0, "lag_max": None})


def _aim(graph, m):
    if m["obj_type"] not in fixed.OBJECTIVES:
        raise Refused(f"unknown objective {m['obj_type']}")
    objective = {"type": m["obj_type"]}
    if m["obj_type"] == "minimize_weighted_tardiness":
        if not m.get("task_weights") or not m.get("task_deadlines"):
            raise Refused("weighted tardiness needs weights and deadlines")
        objective |= {"task_weights": m["task_weights"], "task_deadlines": m["task_deadlines"]}
    graph["objective"] = objective


def _modes(graph, m) -> tuple[dict, list[dict]]:
    activity = _pick(graph["activities"], "id", m["activity_id"])
    return activity, activity.get("modes") or []


def _profile(graph, m):
    mode = _pick(_modes(graph, m)[1], "mode_id", m["mode_id"])
    mode["duration"] += m.get("duration_delta") or 0
    if mode["duration"] <= 0:
        raise Refused("duration must stay positive")
    for name, deltas in (("renewable_demands", "demand_deltas"), ("nonrenewable_demands", "nonrenewable_deltas")):
        for k, v in (m.get(deltas) or {}).items():
            mode[name][k] = max(0, (mode.get(name) or {}).get(k, 0) + v)


def _restrict(graph, m):
    activity, modes = _modes(graph, m)
    activity["modes"] = [x for x in modes if x["mode_id"] not in m["remove_mode_ids"]]
    if not activity["modes"]:
        raise Refused("no mode would be left")


def _new_mode(graph, m):
    activity, modes = _modes(graph, m)
    demands = {k: m.get(k) or {} for k in ("renewable_demands", "nonrenewable_demands")}
    if m["duration"] <= 0 or any(v < 0 for d in demands.values() for v in d.values()):
        raise Refused("a mode needs a positive duration and no negative demands")
    activity["modes"] = [*modes, {"mode_id": max((x["mode_id"] for x in modes), default=0) + 1, "duration": m["duration"], **demands}]


def _spend(graph, m):
    resource = _pick(graph["resources"], "id", m["resource"])
    if not 0 < m["delta"] < resource["capacity"]:
        raise Refused("the cut must be positive and smaller than the budget")
    resource["capacity"] -= m["delta"]


OPERATIONS = {
    "reduce_capacity": _add_window, "freeze_resource": _add_window, "enforce_time_lag": _tighten, "add_precedence": _link, "alter_objective": _aim,
    "alter_mode_profile": _profile, "restrict_modes": _restrict, "add_mode": _new_mode, "reduce_nonrenewable_budget": _spend,
}


def mutate(graph: dict, specs: list[dict]) -> dict:
    """A new graph with all resolved specs applied in order; the input is left as it is."""
    out = copy.deepcopy(graph)
    for m in specs:
        if m["op"] not in OPERATIONS:
            raise Refused(f"unknown operation {m['op']}")
        OPERATIONS[m["op"]](out, m)
        out["mutations_applied"] = [*(out.get("mutations_applied") or []), m]
    return out


def form_reason(specs: list[dict] | None, kind: str) -> str | None:
    """Form of a provider's specs: a list of allowed operations with their keys."""
    if not specs:
        return "no mutations"
    for k, m in enumerate(specs):
        if m.get("op") not in fixed.ALLOWED_OPS.get(kind, ()):
            return f"#{k}: operation {m.get('op')} is not allowed for {kind}"
        for key in fixed.REQUIRED_KEYS.get(m["op"], ()):
            if m.get(key) is None:
                return f"#{k}: {m['op']} needs {key}"
    return None


def least_budget(graph: dict, resource: str) -> int:
    return sum(min(((m.get("nonrenewable_demands") or {}).get(resource, 0) for m in a.get("modes") or [{}]), default=0) for a in graph["activities"])


def _bounds(m: dict, graph: dict, kind: str) -> str | None:
    op, resource = m["op"], next((r for r in graph["resources"] if r["id"] == m.get("resource")), None)
    if op in ("reduce_capacity", "freeze_resource"):
        if m["delta"] <= 0:
            return "delta must be > 0"
        if op == "reduce_capacity" and m["delta"] >= resource["capacity"]:
            return "delta >= capacity; freeze_resource is for a full shutdown"
        if resource.get("type") == "nonrenewable":
            return "a budget has no downtime"
        return "t_start >= t_end" if m["t_start"] >= m["t_end"] else None
    if op == "enforce_time_lag":
        if m["relation"] not in fixed.RELATIONS:
            return f"unknown relation {m['relation']}"
        if m["lag_min"] < 0:
            return "lag_min must be >= 0"
        if m.get("lag_max") is not None:
            return "lag_max must be > lag_min" if m["lag_max"] <= m["lag_min"] else "lag_max is not allowed for TYPE-A" if kind == "TYPE-A" else None
        return None
    if op in ("alter_mode_profile", "restrict_modes"):
        activity = next(a for a in graph["activities"] if a["id"] == m["activity_id"])
        modes = activity.get("modes") or []
        if op == "alter_mode_profile":
            mode = next((x for x in modes if x["mode_id"] == m["mode_id"]), None)
            if mode is None:
                return f"unknown mode {m['mode_id']}"
            return "duration must stay positive" if mode["duration"] + (m.get("duration_delta") or 0) <= 0 else None
        left = [x for x in modes if x["mode_id"] not in m["remove_mode_ids"]]
        if not left:
            return "no mode would be left"
        rest = {**graph, "activities": [{**a, "modes": left} if a is activity else a for a in graph["activities"]]}
        short = next((r["id"] for r in graph["resources"] if r.get("type") == "nonrenewable" and least_budget(rest, r["id"]) > r["capacity"]), None)
        return f"budget {short} cannot cover the modes that are left" if short else None
    if op == "reduce_nonrenewable_budget":
        if resource.get("type") != "nonrenewable":
            return f"{m['resource']} is not a budget"
        if not 0 < m["delta"] < resource["capacity"]:
            return "the cut must be positive and smaller than the budget"
        return "the rest of the budget cannot cover the least demand" if least_budget(graph, m["resource"]) > resource["capacity"] - m["delta"] else None
    return None


def spec_reason(specs: list[dict], graph: dict) -> str | None:
    """Why resolved specs are invalid: first failure by position, each alone; then all together and the cycle test."""
    kind = graph["type"]
    activities, resources = {a["id"] for a in graph["activities"]}, {r["id"] for r in graph["resources"]}
    for k, m in enumerate(specs):
        if m["op"] not in fixed.ALLOWED_OPS.get(kind, ()):
            return f"#{k}: operation {m['op']} is not allowed for {kind}"
        missing = next((f"unknown activity {m[f]}" for f in ("activity_id", "i", "j") if m.get(f) is not None and m[f] not in activities), None)
        if missing is None and m.get("resource") is not None and m["resource"] not in resources:
            missing = f"unknown resource {m['resource']}"
        reason = missing or _bounds(m, graph, kind)
        if reason:
            return f"#{k}: {reason}"
    try:
        return cycle_reason(mutate(graph, specs))
    except (Refused, KeyError, TypeError) as e:
        return f"mutation failed: {e}"


def after_reason(graph: dict) -> str | None:
    """Cycles, and resources that are needed but shut for the whole horizon."""
    if reason := cycle_reason(graph):
        return reason
    span = sum(duration_of(a) for a in graph["activities"]) + sum(max(0, p["lag_min"]) for p in graph.get("precedences") or [])
    for r in graph["resources"]:
        shut = sum(w["end"] - w["start"] for w in r.get("downtime") or [] if w["delta"] >= r["capacity"])
        used = any((a.get("demands") or {}).get(r["id"], 0) > 0 or any((m.get("renewable_demands") or {}).get(r["id"], 0) > 0 for m in a.get("modes") or []) for a in graph["activities"])
        if used and shut and shut >= span:
            return f"{r['id']} is shut for the whole horizon"
    return None


def _near(a: str, b: str) -> str:
    """Either order, with at most a few words between; the first term must be followed by white space."""
    gap = rf"\s+(?:\S+\s+){{0,{fixed.PROXIMITY_WORDS}}}\s*"
    a, b = re.escape(a), re.escape(b)
    return f"(?:{a}{gap}{b}|{b}{gap}{a})"


def model_signals(model: dict, base: dict) -> list[dict]:
    """What the model has that the text must speak of."""
    out = [{"kind": "downtime", "resource": r["id"]} for r in model.get("resources") or [] for _ in r.get("downtime") or []]
    before = {(p["i"], p["j"], p["relation"]): p for p in base.get("precedences") or []}
    for p in model.get("precedences") or []:
        old = before.get((p["i"], p["j"], p["relation"]))
        if old is None or p["lag_min"] > old["lag_min"] or (p.get("lag_max") is not None and old.get("lag_max") is None):
            out.append({"kind": "time_lag", "i": p["i"], "j": p["j"], "relation": p["relation"]})
    aim = (model.get("objective") or {}).get("type", "minimize_makespan")
    if aim != "minimize_makespan":
        out.append({"kind": "objective_change", "aim": aim})
    n_modes = {a["id"]: len(a.get("modes") or []) for a in base.get("activities") or []}
    out += [{"kind": "mode_restriction", "activity": a["id"]} for a in model.get("activities") or [] if len(a.get("modes") or []) < n_modes.get(a["id"], 0)]
    return out


def has_evidence(signal: dict, text: str, sentences: list[str]) -> bool:
    kind = signal["kind"]
    if kind == "downtime":
        return any(re.search(_near(signal["resource"].lower(), phrase), text, re.I) for phrase in fixed.DOWNTIME_PHRASES)
    if kind == "objective_change":
        return any(phrase in text for phrase in fixed.OBJECTIVE_PHRASES.get(signal["aim"], ()))
    if kind == "time_lag":
        names, phrases = [f"t{signal['i']}", f"t{signal['j']}"], fixed.LAG_PHRASES.get(signal["relation"], fixed.LAG_PHRASES["FS"])
    else:
        names, phrases = [f"t{signal['activity']}"], fixed.MODE_PHRASES
    return any(all(n in s for n in names) and any(re.search(p, s) for p in phrases) for s in sentences)


def invented_downtime(text: str, sentences: list[str], model: dict) -> str | None:
    """A resource that the text puts out of service and the model does not."""
    resources = model.get("resources") or []
    down = {r["id"].lower() for r in resources if r.get("downtime")}
    for sentence in sentences:
        if any(phrase in sentence for phrase in fixed.DOWNTIME_PHRASES):
            for r in resources:
                name = r["id"].lower()
                if name not in down and re.search(rf"(?<![a-z0-9_]){re.escape(name)}(?![a-z0-9_])", sentence):
                    return name
    return None


def consistency_of(disruption: str | None, model: dict, base: dict) -> str | None:
    if disruption is None:
        return "the text has no section on the disruption"
    text = disruption.lower()
    sentences = re.split(r"(?<=[.!?])\s+", text)
    for signal in model_signals(model, base):
        if not has_evidence(signal, text, sentences):
            return f"the text does not tell of {signal['kind']} " + " ".join(str(v) for k, v in signal.items() if k != "kind")
    name = invented_downtime(text, sentences, model)
    return f"the text stops {name}, the model does not" if name else None
