"""Operators for preparing training data: tokens, repeats, near copies, extraction, quality, chat."""
