"""Final oracle statements, one per registered Spark query."""

from __future__ import annotations

from . import final

final("ds_tenant_lea_ownership", "o_tenant_lea_ownership")
final("ds_dim_lea", "o_dim_lea")
final("ds_dim_school", "o_dim_school")
final("ds_dim_school_calendar", "o_dim_school_calendar", bigint=("school_year",),
      lists=("applicable_grade_levels_array",))
final("ds_dim_calendar_date", "o_dim_calendar_date",
      bigint=("school_year", "day_of_school_year", "week_of_calendar_year", "week_of_school_year"),
      lists=("calendar_events_array",))
final("ds_school_calendar_windows", "o_school_calendar_windows", bigint=("school_year",))
final("ds_dim_session", "o_dim_session", bigint=("school_year", "total_instructional_days"))
final("ds_dim_student", "o_dim_student", bigint=("school_year", "grade_level_integer", "reading_level"), lists=("race_array",),
      json_lists=("cohort_year_array",))
final("ds_fct_student_school_association", "o_fct_enrollment", bigint=("school_year", "grade_level_integer"))
final("ds_fct_student_school_attendance_event", "o_fct_att_event", bigint=("school_year",), double=("is_absent",))
final("ds_attendance_sessions", "o_attendance_sessions", bigint=("total_instructional_days",))
final("ds_fct_student_daily_attendance", "o_fct_daily",
      bigint=("school_year", "consecutive_days_by_excusal_status", "absentee_category_rank"),
      double=("is_absent", "is_present", "is_enrolled", "total_days_enrolled", "cumulative_days_absent",
              "cumulative_days_attended", "cumulative_days_enrolled", "cumulative_attendance_rate"))
final("ds_msr_student_cumulative_attendance", "o_msr_cum",
      bigint=("school_year", "absentee_category_rank"),
      double=("days_absent", "days_attended", "days_enrolled", "attendance_rate"))
final("ds_dim_subgroup", "o_dim_subgroup")
final("ds_fct_student_subgroup", "o_fct_student_subgroup", bigint=("school_year",))
final("ds_dim_program", "o_dim_program", bigint=("school_year",))
final("ds_fct_student_program_association", "o_fct_program_assoc", bigint=("school_year",))
final("ds_student_programs", "o_student_programs")
final("ds_fct_student_program_service", "o_fct_program_service")
final("ds_dim_local_account", "o_dim_local_account", bigint=("fiscal_year",))
final("ds_fct_local_actual_snapshots", "o_fct_actuals", bigint=("fiscal_year",))
final("q1_students_by_subgroup", "o_q1", bigint=("school_year",))
final("q2_attendance_rate_by_subgroup", "o_q2", bigint=("school_year",),
      double=("total_days_attended", "total_days_enrolled", "attendance_rate"))
final("ds_school_address", "o_school_address")
final("ds_wide_ids_school", "o_wide_ids_school")
final("ds_dim_course", "o_dim_course", bigint=("school_year",), lists=("subject_array",))
final("ds_dim_course_section", "o_dim_course_section",
      bigint=("school_year", "available_credits", "instructional_time_planned", "sequence_of_course"),
      lists=("course_level_characteristics_array",))
final("ds_dim_grading_period", "o_dim_grading_period", bigint=("school_year", "period_sequence"))
final("ds_fct_student_grades", "o_fct_grades", bigint=("school_year", "grade_sort_index"),
      double=("unweighted_gpa_points",))
final("ds_dim_discipline_incident", "o_dim_discipline_incident", bigint=("school_year",), json_lists=("behavior_array",))
final("ds_stu_discipline_action__stu_incident_behavior", "o_action_behaviors",
      lists=("k_student_discipline_incident_behavior_array",))
final("ds_fct_student_discipline_actions", "o_fct_discipline_actions", bigint=("school_year", "severity_order"),
      lists=("k_staff_array", "k_student_discipline_incident_behavior_array"))
final("ds_fct_student_discipline_incident_behaviors", "o_fct_incident_behaviors",
      bigint=("school_year", "severity_order"), lists=("participation_codes_array",))
final("dq_d4_attendance_event_codes", "o_dq_d4", bigint=("api_year",))
final("dq_d5_behavior_types", "o_dq_d5")
final("dq_d6_calendar_event_codes", "o_dq_d6", bigint=("api_year",))
final("dq_d7_discipline_actions", "o_dq_d7")
final("dq_d8_letter_grades", "o_dq_d8", bigint=("api_year",))
final("dq_d12_attendance_dates_without_calendar", "o_dq_d12")
final("dq_d13_enrollments_with_ambiguous_calendars", "o_dq_d13", bigint=("school_year", "n_students_missing_calendar"),
      double=("pct_missing",))
final("dq_d20_missing_demographics", "o_dq_d20", bigint=("api_year",))
final("dq_d25_attendance_event_duplicates", "o_dq_d25", double=("is_absent",))
final("ds_qc_attendance_freshness", "o_qc_freshness", bigint=("school_year",))
final("dq_d26_attendance_freshness", "o_dq_d26", bigint=("school_year",))
final("dq_d28_invalid_enrollments", "o_dq_d28", bigint=("school_year", "enrollment_seq"))
final("dq_d29_overlapping_enrollments", "o_dq_d29")
final("dq_d30_student_attendance_total_days", "o_dq_d30", bigint=("school_year", "absentee_category_rank"),
      double=("days_absent", "days_attended", "days_enrolled", "attendance_rate"))
final("dq_d32_grain_fct_student_grades", "o_dq_d32_grades")
final("dq_d32_grain_fct_student_daily_attendance", "o_dq_d32_daily")
final("dq_d33_orphan_grade_students", "o_dq_d33_grades")
final("q3_active_students_by_grade", "o_q3")
final("q4_enrolled_in_february", "o_q4", bigint=("school_year",))
final("q5_discipline_counts", "o_q5")
final("q6_suspension_rate", "o_q6", bigint=("school_year", "n_students_suspended"), double=("suspension_rate",))
final("q9_program_enrollments_with_services", "o_q9", bigint=("school_year",))
final("ds_dim_assessment", "o_dim_assessment", bigint=("school_year",),
      lists=("scores_array", "grades_array"), json_lists=("performance_levels_array",))
final("ds_student_assessments_long_results", "o_long_results", bigint=("api_year",))
final("ds_fct_student_assessment", "o_fct_student_assessment", bigint=("school_year",))
final("q10_other_result_score", "o_q10", bigint=("school_year", "percentile"))
final("ds_fct_student_section_association", "o_fct_student_section", bigint=("school_year",))
final("ds_staff_official_emails", "o_staff_official_emails")
final("ds_dim_staff", "o_dim_staff")
final("ds_fct_staff_section_association", "o_fct_staff_section", bigint=("school_year",))
final("ds_qc_sections_per_enrollment", "o_sections_per_enrollment", bigint=("school_year",))
final("dq_d18_enrollments_without_overlapping_sections", "o_dq_d18", bigint=("school_year",))
final("dq_d22_schools_with_enrollments_without_sections", "o_dq_d22",
      bigint=("school_year", "n_enrollments_without_sections"))
final("dq_d23_sections_without_staff", "o_dq_d23",
      bigint=("school_year", "available_credits", "instructional_time_planned", "sequence_of_course"),
      lists=("course_level_characteristics_array",))
final("dq_d24_sections_without_students", "o_dq_d24",
      bigint=("school_year", "available_credits", "instructional_time_planned", "sequence_of_course"),
      lists=("course_level_characteristics_array",))
final("ds_parent_wide_emails", "o_parent_wide_emails")
final("ds_dim_parent", "o_dim_parent", bigint=("school_year",))
final("ds_fct_student_parent_association", "o_fct_student_parent", bigint=("school_year", "contact_priority"))
final("dq_d14_students_with_multiple_primary_contacts", "o_dq_d14", bigint=("school_year", "n_primary_contacts"))
final("dq_d21_parent_association_multiple_years", "o_dq_d21")
final("ds_student__other_names", "o_other_names", bigint=("api_year",))
final("ds_student_indicators", "o_student_indicators", bigint=("api_year", "reading_level"))
final("ds_dim_class_period", "o_dim_class_period", bigint=("school_year", "n_meeting_times", "class_duration", "period_duration"))
final("ds_dim_cohort", "o_dim_cohort", bigint=("school_year",))
final("ds_fct_student_cohort_association", "o_fct_cohort", bigint=("school_year",))
final("ds_fct_student_academic_record", "o_fct_academic_record", bigint=("school_year", "cumulative_earned_credits"))
final("ds_combine_gpas", "o_combine_gpas", bigint=("api_year",), double=("max_gpa_value",))
final("ds_fct_student_gpa", "o_fct_gpa", bigint=("school_year",), double=("max_gpa_value",))
final("ds_fct_student_diploma", "o_fct_diploma", bigint=("school_year",))
final("dq_d27_diploma_record_duplicates", "o_dq_d27", bigint=("school_year",))
final("q8_gpa_with_latest_student", "o_q8", bigint=("school_year",))
final("q8_transcripts_with_latest_student", "o_q8_transcripts", bigint=("school_year",))
final("q8_records_with_latest_student", "o_q8_records", bigint=("school_year", "cumulative_earned_credits"))
final("ds_fct_staff_school_association", "o_fct_staff_school", bigint=("school_year", "order_of_assignment"),
      double=("full_time_equivalency",))
final("q7_latest_staff_assignment", "o_q7")
final("ds_course_char__combined_long", "o_course_char_long", bigint=("api_year",))
final("ds_course_char__combined_wide", "o_course_char_wide", bigint=("api_year",), lists=("course_level_characteristics_array",))
final("ds_course_subject", "o_course_subject", bigint=("api_year",), lists=("subject_array",))
final("ds_wide_ids_course", "o_wide_ids_course", bigint=("api_year",))
final("ds_brg_course_section_program", "o_brg_section_program")
final("ds_immutable_candidate_demos", "o_immutable_candidate_demos", bigint=("school_year",), lists=("race_array",))
final("ds_dim_candidate", "o_dim_candidate", bigint=("school_year",), lists=("race_array",))
final("ds_dim_educator_preparation_program", "o_dim_epp")
final("ds_fct_candidate_educator_preparation_program_association", "o_fct_candidate_epp", bigint=("school_year",))
final("ds_dim_certification_exam", "o_dim_cert_exam", bigint=("school_year",))
final("ds_fct_certification_exam_result", "o_fct_cert_result", bigint=("school_year", "attempt_number"))
final("ds_fct_candidate_staff_association", "o_fct_candidate_staff", bigint=("api_year",))
final("ds_dim_student_custom", "o_dim_student_custom", bigint=("school_year", "grade_level_integer", "reading_level"),
      lists=("race_array",), json_lists=("cohort_year_array",))
final("ds_fct_student_grades_custom", "o_fct_grades_custom", bigint=("school_year", "grade_sort_index", "attempt"),
      double=("unweighted_gpa_points",))
final("ds_fct_student_homeless_program_association_custom", "o_fct_homeless_program_custom", bigint=("school_year",))
final("ds_dim_school_custom", "o_dim_school_custom", bigint=("api_year",))
final("dq_d17_custom_student_sources_unique", "o_dq_d17")
final("ds_dim_network", "o_dim_network")
final("ds_wide_school_network_assoc", "o_wide_network")
final("ds_fct_student_program_participation_status", "o_participation_status")
final("ds_fct_local_budget_snapshots", "o_fct_budgets", bigint=("fiscal_year",))
final("ds_fct_student_section_attendance_event", "o_fct_section_events", bigint=("school_year",),
      double=("is_absent",))
final("dq_d10_section_attendance_event_codes", "o_dq_d10", bigint=("api_year",))
final("dq_d2_assessments_without_score_mapping", "o_dq_d2", bigint=("school_year",))
final("ds_fct_course_transcripts", "o_fct_transcripts", bigint=("school_year",))
final("ds_dim_chart_of_account", "o_dim_chart_of_account", bigint=("fiscal_year",))
final("ds_dim_esc", "o_dim_esc")
final("ds_dim_objective_assessment", "o_dim_objective_assessment",
      bigint=("school_year", "max_raw_score", "percent_of_assessment"), lists=("scores_array",),
      json_lists=("performance_levels_array",))
final("ds_student_assessment_cross_tenant_custom", "o_asmt_copies", bigint=("school_year", "api_year"))
final("ds_student_objective_assessment_cross_tenant_custom", "o_objective_copies", bigint=("school_year", "api_year"))
final("ds_dim_assessment_custom", "o_dim_assessment_copied", bigint=("school_year",),
      lists=("scores_array", "grades_array"), json_lists=("performance_levels_array",))
final("ds_dim_objective_assessment_custom", "o_dim_objective_copied",
      bigint=("school_year", "max_raw_score", "percent_of_assessment"), lists=("scores_array",),
      json_lists=("performance_levels_array",))
final("ds_fct_student_assessment_custom", "o_fct_student_assessment_copied", bigint=("school_year",))
final("ds_fct_student_objective_assessment_custom", "o_fct_student_objective_copied", bigint=("school_year",))
final("ds_student_objective_assessments_long_results", "o_obj_long")
final("ds_fct_student_objective_assessment", "o_fct_student_objective", bigint=("school_year",))
final("dq_d9_objective_assessments_without_score_mapping", "o_dq_d9", bigint=("school_year",))
final("ds_fct_student_discipline_actions_summary", "o_actions_summary", bigint=("school_year",),
      lists=("behavior_types_array", "incident_id_array", "discipline_actions_array"))
final("ds_wide_ids_student", "o_wide_ids_student", bigint=("api_year",))
final("ds_wide_ids_staff", "o_wide_ids_staff", bigint=("api_year",))
final("ds_staff_race_ethnicity", "o_staff_race", lists=("race_array",))

for _build in ("special_education", "language_instruction", "homeless", "title_i_part_a", "cte", "food_services", "migrant_education"):
    final(f"ds_student_program__{_build}", f"o_program_{_build}_all" if _build == "title_i_part_a" else f"o_program_{_build}")
    final(f"ds_student_program__{_build}__program_services", f"o_services_{_build}", bigint=("api_year",), lists=("program_services",))
final("ds_student_program__food_service", "o_program_food_services")
final("ds_student_program__program_services", "o_services_generic", bigint=("api_year",), lists=("program_services",))
final("ds_student_program__homeless_custom", "o_program_homeless_custom")
final("ds_student_program__title_i_part_a_custom", "o_program_title_i_part_a_custom")
final("ds_fct_student_homeless_program_association", "o_fct_homeless_program", bigint=("school_year",))
final("ds_fct_student_language_instruction_program_association", "o_fct_language_instruction_program", bigint=("school_year",))
final("ds_fct_student_special_education_program_association", "o_fct_special_education_program", bigint=("school_year",),
      lists=("special_education_program_services",))
final("ds_fct_student_title_i_part_a_program_association", "o_fct_title_i_part_a_program", bigint=("school_year",))
final("ds_fct_student_cte_program_association", "o_fct_cte_program", bigint=("school_year",))
final("ds_fct_student_school_food_service_program_association", "o_fct_school_food_service_program", bigint=("school_year",))
final("ds_fct_student_migrant_education_program_association", "o_fct_migrant_education_program", bigint=("school_year",))
final("ds_fct_student_discipline_incident_summary", "o_incident_summary", bigint=("school_year",),
      lists=("behavior_types_array", "discipline_actions_array"))
final("ds_fct_student_discipline_incident_non_offenders", "o_non_offenders", lists=("participation_codes_array",))
final("ds_dim_classroom", "o_dim_classroom", bigint=("maximum_seating",))
final("ds_dim_graduation_plan", "o_dim_graduation_plan", bigint=("school_year", "total_required_credits"))
final("ds_dim_learning_standard", "o_dim_learning_standard")
final("ds_fct_student_learning_standard_grades", "o_fct_ls_grades")
final("ds_student_cohort_years", "o_cohort_years", bigint=("api_year",), json_lists=("cohort_year_array",))
final("ds_student_program__special_education__primary_disability", "o_primary_disability", bigint=("school_year", "order_of_disability"))
final("ds_wide_ids_lea", "o_wide_ids_lea", bigint=("api_year",))
final("ds_objective_assessment_scores", "o_objective_scores", bigint=("api_year",), lists=("scores_array",))
final("ds_objective_assessment_performance_levels", "o_objective_pls", bigint=("api_year",),
      json_lists=("performance_levels_array",))
final("ds_choose_stu_demos", "o_choose_stu_demos", bigint=("api_year",))
final("ds_stu_race_ethnicity", "o_stu_race", lists=("race_array",))
final("ds_stu_grade_level", "o_stu_grade", bigint=("school_year", "grade_level_integer"))
final("ds_student_characteristics", "o_stu_chars", bigint=("api_year",))
final("ds_immutable_stu_demos", "o_immutable_stu_demos", bigint=("school_year",), lists=("race_array",))
final("ds_parent_wide_phone_numbers", "o_parent_wide_phones")
final("ds_staff_emails", "o_staff_emails")
final("ds_assessment_scores", "o_assessment_scores", bigint=("api_year",), lists=("scores_array",))
final("ds_assessment_grade_levels", "o_assessment_grade_levels", bigint=("api_year",), lists=("grades_array",))
final("ds_candidate_race_ethnicity", "o_candidate_race", lists=("race_array",))
final("ds_candidate__other_names", "o_candidate_other_names", bigint=("api_year",))
final("ds_stu_grade_level_custom", "o_stu_grade_custom", bigint=("school_year", "grade_level_integer"))
final("dq_d19_grade_level_override_unique", "o_dq_d19")
final("ds_dim_course_section_custom", "o_dim_course_section_custom",
      bigint=("school_year", "available_credits", "instructional_time_planned", "sequence_of_course"),
      lists=("course_level_characteristics_array",))
final("ds_fct_student_diploma_custom", "o_fct_diploma_custom", bigint=("school_year",))
final("dq_d27_diploma_record_duplicates_custom", "o_dq_d27_custom", bigint=("school_year",))
final("dq_d16_custom_course_sources_unique", "o_dq_d16")
final("dq_d15_custom_course_section_sources_unique", "o_dq_d15")
