"""Record types of the engine as Spark DDL."""

from __future__ import annotations

BBOX = "struct<x0: double, y0: double, x1: double, y1: double>"
TEXT_LINE = f"page_number int, column_index int, text string, bbox {BBOX}"
TEXT_BLOCK = f"page int, page_height double, bbox {BBOX}, text string, column_label string"
CHOICE = "struct<number: int, text: string>"
IMAGE = "struct<image_id: string, image_name: string, image_caption: string>"
QUESTION = f"question_no int, subject string, page_range array<int>, column_range array<string>, stem string, choices array<{CHOICE}>, answer string, explanation string, raw_text string, confidence double"
QUESTION_START = "page_index int, column int, y0 double, qno int"
SPAN_SEGMENT = "struct<page_index: int, column: int, start_y: double, end_y: double>"
QUESTION_SPAN = f"index int, qno int, segments array<{SPAN_SEGMENT}>"
IMAGE_SET = "index int, qno int, problem_image_paths array<string>, choices_image_paths array<string>"
TEXT_SET = "index int, qno int, question_text string, choices_text string"
SHARED_PASSAGE = "passage_id string, start_qno int, end_qno int, text string, image_paths array<string>"
CONVERSION = "source string, pages int, elements int, images int, questions int"
MARKDOWN_QUESTION = "qno int, content string"
ELEMENT = "doc_id string, path array<int>, parent_path array<int>, role string, type string, id int, page_number int, bbox array<double>, content string, numbering_style string, source string, heading_level int"
OPTION = f"struct<`order`: int, is_correct: boolean, content: string, images: array<{IMAGE}>, option_explanation: string>"
FINAL_QUESTION = f"content string, question_source string, images array<{IMAGE}>, hint_explanation string, options array<{OPTION}>"
