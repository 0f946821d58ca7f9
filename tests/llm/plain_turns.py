"""Plain versions of the two operators on conversations."""

import hashlib
import re
import zlib
from collections import defaultdict


def crc(text):
    return zlib.crc32(text.encode())


def order_key(turn, role, text):
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    return (turn is not None, turn or 0, digest)


def plain_trie(rows):
    """Nodes of the trie of rebuilt conversations, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((*order_key(turn, role or "", text or ""), role or "", text or ""))
    own = {c: [(r[3], r[4]) for r in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h, base = crc(str(c)) % 4, c - (c - 20 * int(c / 20))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved_tokens = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved_tokens[node] = (len(members[node]) - 1) * words + sum(saved_tokens[k] for k in children[node])
    out = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved_tokens[node], digest))
    return out


def cheapest_by_states(codes):
    """Cost and audit of the cheapest edits, by the least (cost, audit) of each state after each turn."""
    steps = {"e": {"s": "s", "u": "a"}, "s": {"u": "a"}, "a": {"a": "p"}, "p": {"u": "a"}}

    def inserted(states):
        waiting = list(states.items())
        while waiting:
            state, (cost, audit) = waiting.pop()
            for wanted, into in steps[state].items():
                found = (cost + 2, audit + "I")
                if wanted != "s" and found < states.get(into, (10**9, "")):
                    states[into] = found
                    waiting.append((into, found))
        return states

    states = inserted({"e": (0, "")})
    for code in codes:
        after = {}

        def offer(state, found):
            if found < after.get(state, (10**9, "")):  # noqa: B023
                after[state] = found  # noqa: B023

        for state, (cost, audit) in states.items():
            offer(state, (cost + 3, audit + "D"))
            for wanted, into in steps[state].items():
                if code == "x":
                    continue
                extra = 1 if code.isupper() else 0
                if code.lower() == wanted:
                    offer(into, (cost + extra, audit + "K"))
                elif wanted != "s":
                    offer(into, (cost + extra + 2, audit + "R"))
        states = inserted(after)
    return min(found for state, found in states.items() if state in "ep")


def plain_repair(rows):
    """One tuple per conv_id, from (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        kept = convs[conv]
        key = order_key(turn, role, text)
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        kept.append((key, turn, role, text))
        if fault == 3:
            kept.append((key, turn, role, text))
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[0])
        seen, counts, codes = set(), [0, 0, 0], ""
        for _, _, role, text in turns:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            who = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += "x" if fault in (0, 1) else who.upper() if fault == 2 else who
            if fault is not None:
                counts[fault] += 1
        numbers = [t[1] for t in turns if t[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        roles = [t[2] for t in turns]
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, audit = cheapest_by_states(codes)
        lines, left = [], [(t[2], t[3]) for t in turns]
        for edit in audit:
            has_system = bool(lines) and lines[0][0][:1] == "s"
            wanted = "a" if (len(lines) - has_system) % 2 else "u"
            if edit == "I":
                lines.append(({"u": "user", "a": "assistant"}[wanted], ""))
                continue
            role, text = left.pop(0)
            if edit == "K":
                lines.append((role, text))
            elif edit == "R":
                lines.append(({"u": "user", "a": "assistant"}[wanted], text))
        assert not left and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in lines)), (codes, audit)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return out
