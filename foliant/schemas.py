"""Schemas of the tables that flow between operators (DDL)."""

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
PAPERS = "paper_ord bigint, arxiv_id string, full_id string, pdf_url string, status string, image_count int, error_message string"
PAGES = "arxiv_id string, page int, text string"
BLOCKS = f"arxiv_id string, block_ord int, page int, text string, bbox {BOX}"
DRAWINGS = f"arxiv_id string, page int, draw_ord int, rect {BOX}, page_w double, page_h double"
LAYOUT = "arxiv_id string, page int, blk_ord int, type string, score double, x_1 double, y_1 double, x_2 double, y_2 double"
FIGURES = f"arxiv_id string, fig_ord int, image binary, page_number int, figure_index int, bbox {BOX}, width int, height int, extraction_method string, caption_candidates array<string>"
ENTRY = "struct<arxiv_id:string,page_number:int,figure_number:int,quantum_gates:array<string>,quantum_problem:string,descriptions:array<string>,text_positions:array<array<int>>>"
DATASET = f"map<string,{ENTRY}>"
STATISTICS = "struct<total_papers_processed:bigint,total_images_extracted:bigint,total_circuits_found:bigint,papers_with_circuits:bigint,gate_distribution:map<string,bigint>,algorithm_distribution:map<string,bigint>,avg_gates_per_circuit:double,avg_descriptions_per_image:double>"
STATUSES = ("not_visited", "processed", "failed", "skipped")
METHODS = ("layout_analysis", "embedded_image", "vector_render")
