"""Schemas of documents and tables. Only what is read of a document is declared, so that only that is parsed."""

from __future__ import annotations

_DATE = "struct<date:string,type:string>"
_OUTCOMES = "array<struct<measure:string,description:string,timeFrame:string>>"
_MESHES = "struct<meshes:array<struct<id:string,term:string>>>"

STUDY = f"""
protocolSection struct<
  identificationModule:struct<nctId:string,orgStudyIdInfo:struct<id:string>,secondaryIdInfos:array<struct<id:string>>,briefTitle:string,officialTitle:string,acronym:string,organization:struct<fullName:string>>,
  statusModule:struct<overallStatus:string,statusVerifiedDate:string,whyStopped:string,expandedAccessInfo:struct<hasExpandedAccess:string>,startDateStruct:{_DATE},primaryCompletionDateStruct:{_DATE},completionDateStruct:{_DATE},studyFirstPostDateStruct:{_DATE},lastUpdatePostDateStruct:{_DATE},studyFirstSubmitDate:string,studyFirstSubmitQcDate:string,lastUpdateSubmitDate:string>,
  sponsorCollaboratorsModule:struct<leadSponsor:struct<name:string,class:string>,responsibleParty:struct<type:string>,collaborators:array<struct<name:string>>>,
  oversightModule:struct<isFdaRegulatedDrug:string,isFdaRegulatedDevice:string,oversightHasDmc:string>,
  descriptionModule:struct<briefSummary:string,detailedDescription:string>,
  conditionsModule:struct<conditions:array<string>>,
  designModule:struct<studyType:string,phases:array<string>,designInfo:struct<allocation:string,interventionModel:string,maskingInfo:struct<masking:string>,primaryPurpose:string>,enrollmentInfo:struct<count:string,type:string>>,
  armsInterventionsModule:struct<interventions:array<struct<type:string,name:string>>>,
  outcomesModule:struct<primaryOutcomes:{_OUTCOMES},secondaryOutcomes:{_OUTCOMES}>,
  eligibilityModule:struct<eligibilityCriteria:string,healthyVolunteers:string,sex:string,minimumAge:string,stdAges:array<string>>,
  contactsLocationsModule:struct<centralContacts:array<struct<name:string,role:string,phone:string,email:string>>,overallOfficials:array<struct<name:string,role:string,affiliation:string>>,locations:array<struct<facility:string,status:string,city:string,state:string,zip:string,country:string>>>,
  ipdSharingStatementModule:struct<ipdSharing:string>,
  referencesModule:struct<references:array<struct<pmid:string,type:string,citation:string>>>>,
derivedSection struct<conditionBrowseModule:{_MESHES},interventionBrowseModule:{_MESHES}>,
documentSection struct<largeDocumentModule:struct<largeDocs:array<struct<filename:string>>>>
""".replace("\n", "")

VERSION_INDEX = "id string, version int, date string, status string, module_labels array<string>"
