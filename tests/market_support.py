"""What the market tests share besides fixtures."""

FOLDER = "/root/testdata/sf0.001"


def as_set(frame, columns=None):
    rows = frame.select(*columns).collect() if columns else frame.collect()
    return sorted((tuple(r) for r in rows), key=repr)
