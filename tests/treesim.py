"""Direct stack simulation of the tree example semantics (an independent check)."""


def simulate(actions):
    """Stack semantics written directly: returns inputs, labels, positions, attended sets."""
    inputs, labels, pos, rows = [], [], [], []
    stack, depth = [], 0
    opener_at = []
    for tok in actions:
        if tok == "<s>":
            kinds = [("B", tok)]
        elif tok == "</s>":
            kinds = [("E", tok)]
        elif tok.startswith("("):
            kinds = [("O", tok)]
        elif tok.endswith(")"):
            kinds = [("C", tok), ("D", tok)]
        else:
            kinds = [("T", tok)]
        for k, t in kinds:
            i = len(inputs)
            inputs.append(t)
            labels.append("<pad>" if k == "D" else t)
            if k == "O":
                pos.append(depth)
                depth += 1
            elif k == "C":
                depth -= 1
                pos.append(depth)
            elif k == "D":
                pos.append(depth)
            elif k == "T":
                pos.append(depth)
            else:
                pos.append(0)
            if k == "E":
                rows.append(set())
            elif k == "C":
                start = opener_at.pop()
                cut = stack.index(start)
                rows.append(set(stack[cut:]) | {i})
                stack = stack[:cut] + [i]
            elif k == "D":
                rows.append(set(stack) | {i})
            else:
                rows.append(set(stack) | {i})
                stack.append(i)
                if k == "O":
                    opener_at.append(i)
    return inputs, labels, pos, rows
