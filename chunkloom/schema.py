"""Column types of pages, pieces, blocks and chunks, as DDL."""

from __future__ import annotations

#: A page as sources give it.
PAGE = "id string, title string, space_key string, space_name string, version int, last_modified string, body_html string, url string"
#: What the readers of HTML and of plain text emit for each page, in document order.
PIECES = "array<struct<block_type:string,text:string,xpath:string,css_selector:string,html_id:string>>"
#: A part of a block that a chunk holds.
FRAGMENT = "struct<block_index:int,block_id:string,block_type:string,xpath:string,css_selector:string,html_id:string,text_offset:int,text_length:int,fragment_start:int,fragment_end:int,text:string>"
HIGHLIGHT = f"struct<text_fragment:string,block_type:string,text_offset:int,first_block_html_id:string,nearest_heading_html_id:string,core_fragments:array<{FRAGMENT}>,overlap_prev_fragments:array<{FRAGMENT}>,chunk_id_base:string,overlap_next_fragments:array<{FRAGMENT}>>"
CHUNK = (
    "chunk_id string, page_id string, space_key string, page_title string, page_version int, last_modified string, "
    "block_indices array<int>, core_block_indices array<int>, overlap_prev_block_indices array<int>, overlap_next_block_indices array<int>, "
    "full_heading_hierarchy array<string>, text_heading_hierarchy array<string>, nearest_heading_id string, "
    "normalized_text string, overlap_prev_text string, overlap_next_text string, full_text string, embedding_text string, "
    "xpath_start string, css_selector_start string, text_offset_start int, text_length int, navigation_url string, "
    f"highlight_metadata {HIGHLIGHT}, chunk_no int"
)
