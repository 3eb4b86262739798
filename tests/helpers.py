import datetime

SMALL = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, float):
        return round(x, 9)
    return x.replace(tzinfo=None) if isinstance(x, datetime.datetime) else x


def rows(df_rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in df_rows), key=repr)
