from corpusengine.sources.files import (  # noqa: F401
    bad_lexicon_lines,
    load_model,
    register_view,
    save_model,
    scan_lexicon,
    scan_parquet,
    scan_word_list,
    write_parquet,
)
