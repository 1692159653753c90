"""Operators on notes and spans.

A note is a row (record_id, raw_text, sections); a span is a row (record_id, gen_ord, text, start, end, ...). Generators
explode matches on the note row, which needs no shuffle; folds over the spans of a note group by record_id, so notes
repartitioned by record_id once serve the whole chain."""
