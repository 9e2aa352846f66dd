from prefspark.sources.io import (  # noqa: F401
    read_pairs,
    read_prompts,
    read_texts,
    read_trees,
    select_split,
    write_shaped,
    write_texts,
)
