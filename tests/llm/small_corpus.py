"""A small corpus with toxic documents, copies and a leaked benchmark item."""

import random


def corpus():
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("aeinrstold") for _ in range(draw.randint(2, 8)))
    leak = " ".join(word() for _ in range(20))
    rows, labels = [], []
    for i in range(300):
        words = [word() for _ in range(draw.randint(40, 150))]
        if i % 6 == 0:
            words[3] = words[20] = "idiot"
        if i % 10 == 1:
            words[10:10] = leak.split()
        text = " ".join(words)
        rows.append((i, text, "en", f"src{i % 5}", len(text)))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(1000 + i, rows[i][1] if i % 2 else rows[i][1] + " end", "en", "src1", 5) for i in range(100)]
    return rows, labels, [(1, leak)]
