"""What several test modules share; named so that no other folder has a module like it."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
