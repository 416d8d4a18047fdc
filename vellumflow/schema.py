"""Schemas of the entities that pass between stages; readers never infer."""

PDF_FILE = "book string, pdf_path string"
PAGE_IMAGE = "book string, base string, file_name string, path string, length bigint, content binary"
PAGE_TEXT = "book string, base string, file_name string, path string, text string"
PAGE_RESULT = "book string, base string, doc_ord int, text string, error string"
NARRATION = "book string, text string"
TEXT_CHUNK = "book string, chunk_no int, chunk string, content_hash string"
AUDIO_CHUNK = "book string, chunk_no int, wav binary"
LLM_RESPONSE = "candidates array<struct<content: struct<parts: array<struct<text: string>>>>>, error struct<message: string>"
BOOK_JSON = "file_name string, file_hash string, processed_date string, total_pages bigint, processed string, name string, content struct<ocr: string, pdf_text: string>"
