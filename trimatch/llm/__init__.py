"""Training-data operators: packing, chat, search, dedup, PII, language
model, token files, quality, decontamination.  Nothing outside this
subpackage imports it, apart from the guarded import of the driver module.
"""
